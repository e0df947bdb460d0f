"""Bronze readers and writers, and the Silver and Gold tables."""
