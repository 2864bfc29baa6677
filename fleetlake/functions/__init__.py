"""Column expressions: file names and UTC times.  Built-in functions only."""
