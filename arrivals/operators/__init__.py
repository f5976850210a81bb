"""Relational operators of the warehouse build (projections, filters, decodes,
aggregates, star links, quality checks)."""
