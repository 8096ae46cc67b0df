"""Table scans, sinks, versioned datasets and the fitted-parameter store."""
