"""Sources and sinks: the sales extract, snapshots, selection tables, report sinks."""
