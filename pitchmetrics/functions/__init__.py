"""Fixed codes and built-in column expressions shared by the operators."""
