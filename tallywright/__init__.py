"""Molecule counting for droplet sequencing, and training-text preparation, as Spark DataFrame operators."""
