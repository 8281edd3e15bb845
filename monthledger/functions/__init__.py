"""Column -> Column building blocks: calendar, money and price rises."""
