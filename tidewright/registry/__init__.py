"""The checked queries: each job on the driver's tables, with its plain-SQL counterpart."""
