"""Column functions: JVM-side expressions only, usable in batch and stream."""
