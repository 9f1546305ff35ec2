"""Sources: explicit schemas, CSV / log-line readers, driver-table views."""
