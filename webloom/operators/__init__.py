"""DataFrame operators: keys, index, graph, search, spelling, history, pages."""
