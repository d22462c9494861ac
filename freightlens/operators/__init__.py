"""DataFrame operators: shaping, filters, joins, upserts, reports, quality checks and dimension builders."""
