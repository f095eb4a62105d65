"""Sales as they arrive: the points ledger and sliding totals on event time."""
