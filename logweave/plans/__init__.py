"""Plan shapes reused by several operators: sliced scans, checked broadcasts, chains, ranks."""
