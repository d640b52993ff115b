"""Job compositions, test fixtures and the registered queries."""
