"""Plain-data configuration: fixed values, prompt texts, model pool."""
