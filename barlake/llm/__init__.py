"""Training-data operators over document, page and label tables; nothing else in the library imports this package."""
