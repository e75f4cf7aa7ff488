"""File scans, versioned tables and sinks."""
