"""Scalar rules as Column -> Column functions; all run JVM-side except the one
full-NFKD variant in ``text``."""
