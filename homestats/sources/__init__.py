"""Sources and sinks: file scans, CSV reads, rate series, derived test relations."""
