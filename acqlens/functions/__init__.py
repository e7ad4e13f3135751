from . import cleaning, fiscal, stats  # noqa: F401
