"""DataFrame operators: joins, aggregates and windows of the impact workload."""
