"""Sources and the rules for what is read, split and read only once."""
