"""DataFrame operators, one function per work item."""
