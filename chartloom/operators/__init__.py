"""Generic DataFrame operators the document plans are made of."""
