"""Writers: partitioned output, partition replacement, per-grain layout, rejects and audit."""
