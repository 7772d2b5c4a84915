"""Sources: landing text deliveries and catalog tables."""
