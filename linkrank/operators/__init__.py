"""DataFrame operators: parse, graph, rank and result steps."""
