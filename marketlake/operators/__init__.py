"""DataFrame operators: maintenance, selection, flattening, linking, series."""
