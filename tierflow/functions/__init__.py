"""Column builders: pure expressions, safe with ANSI mode on."""
