"""Where a run's tables go: staging, dated output, warehouse."""
