"""Query and pipeline plans composed from the operators."""
