"""Errors that the command line maps to exit codes."""


class ConfigError(Exception):
    """A config file is missing, no YAML, or lacks what it needs."""


class MissingPathError(Exception):
    """A folder or file that a command reads is missing or empty."""


class OverwriteError(Exception):
    """A target exists and may not be replaced."""


class OcrDependencyError(Exception):
    """No text recognition engine is installed."""


class HighlightDependencyError(Exception):
    """What highlight detection needs is not installed."""
