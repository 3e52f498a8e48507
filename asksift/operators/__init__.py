"""DataFrame operators: identity, batching, labelling, merging, triage, agreement."""
