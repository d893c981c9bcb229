"""See the modules of this subpackage."""
