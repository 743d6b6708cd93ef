"""DataFrame operators: joins, aggregates, ranking, selection and quality checks."""
