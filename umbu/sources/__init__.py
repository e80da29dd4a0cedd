"""Reading landed files, reading and writing loads, the catalog."""
