"""The jobs, each also a command: ``python -m tidemark.plans.<job> --help``."""
