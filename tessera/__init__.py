"""Tessera: claims analytics and data preparation, declared as Spark plans."""
