"""Column builders. Every function takes and returns built-in ``Column`` expressions."""
