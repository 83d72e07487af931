"""Row operators: projections, validation rules, joins, ranks, sets, paging, reports, text."""
