"""Sources and sinks: driver test tables, JSON landing zone, HTML symbol pages, table layout."""
