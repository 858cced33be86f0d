"""DataFrame operators: selection, topology, folding, integration, results."""
