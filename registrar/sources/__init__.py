"""Sources: record files (root-less XML dumps), delimited mapping files,
table specs and exclusion lists."""
