"""gridloom: gridded-geodata and tabular analytics as lazy Spark plans."""
