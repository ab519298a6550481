"""Tables and landed responses in, tables and exports out."""
