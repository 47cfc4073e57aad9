"""Query plans: serving, quality checks, reports, the build, and the catalogue for the driver's tables."""
