"""touchline package."""
