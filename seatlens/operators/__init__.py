"""Table operators that do not know about offices or visits files."""
