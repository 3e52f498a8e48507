"""Rating tables of the published study, as counts per rating pattern."""

RUNS = [
    "Rules", "run1_a", "run2_a", "run1_b", "run2_b", "run1_c", "run2_c",
]
MANUAL = ["Manual_1", "Manual_2"]

# Cases per pattern, raters in the order of RUNS.
FULL = {
    "0000000": 1862, "0000001": 7, "0000010": 10, "0000100": 30, "0000101": 3,
    "0000110": 1, "0001000": 14, "0001100": 9, "0001101": 1, "0010000": 10,
    "0010001": 1, "0010100": 7, "0010101": 3, "0010110": 1, "0011000": 4,
    "0011100": 2, "0011101": 2, "0100000": 5, "0100001": 1, "0100010": 2,
    "0100100": 1, "0100101": 1, "0101000": 1, "0101110": 1, "0101111": 1,
    "0110011": 1, "0110100": 1, "0110111": 1, "0111000": 2, "0111001": 1,
    "0111011": 2, "0111100": 2, "0111101": 4, "0111110": 2, "0111111": 117,
    "1000000": 3, "1001000": 1, "1011111": 2, "1110111": 1, "1111011": 1,
    "1111100": 1, "1111111": 104,
}
# The reviewed sample, raters in the order of RUNS + MANUAL.
SAMPLE = {
    "000000000": 161, "000000001": 2, "000000010": 5, "000000011": 46,
    "000000111": 2, "000010001": 1, "000010011": 1, "000011011": 1,
    "000100011": 1, "000110011": 1, "001000001": 2, "001000010": 1,
    "001010011": 1, "011011111": 1, "011100011": 1, "011111111": 7,
    "111111111": 12,
}


def frame(spark, patterns, raters):
    """One row per case, as the rating files have it."""
    rows = [
        tuple(int(c) for c in p) for p, n in patterns.items() for _ in range(n)
    ]
    return spark.createDataFrame(rows, ", ".join(f"{r} int" for r in raters))
