"""Writers to files, databases and tables."""
