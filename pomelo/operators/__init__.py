"""The operator catalogue, one module per concern (see SURVEY §7.1)."""
