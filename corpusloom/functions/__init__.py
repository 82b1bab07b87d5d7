"""Column expressions: text transforms, detectors, hashing."""
