"""Column expressions. Nothing here touches data."""
