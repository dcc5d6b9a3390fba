"""Trip operators: normalisation, filters, zone enrichment, stream validation, de-dup."""
