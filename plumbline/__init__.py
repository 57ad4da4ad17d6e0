"""plumbline: per-item metric tables, prototype scoring, box agreement and engine evaluation on Spark."""
