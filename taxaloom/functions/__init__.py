"""Part of the taxaloom engine."""
