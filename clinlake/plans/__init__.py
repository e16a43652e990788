"""The landing, stage, statement and annotation flows built from the operators."""
