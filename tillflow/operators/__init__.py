"""Table operators: column mapping, cleaning, dedup/pick, joins."""
