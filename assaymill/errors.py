"""Typed errors raised by the engine."""


class AssayError(Exception):
    """Base class of every error the engine raises on purpose."""


class ExtractionError(AssayError):
    """A source is missing, empty or structurally broken."""


class PlanError(AssayError):
    """An operator was asked for something its inputs cannot give."""


class GateFailed(AssayError):
    """The raw data is too damaged to be worth cleaning."""


class ValidationFailed(AssayError):
    """A table breaks its specification at a stage that must not be passed."""
