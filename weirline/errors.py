"""The engine's errors. Input errors are the caller's to mend; the rest stop a writer."""


class EngineError(Exception):
    """Base of all errors of the engine."""

    #: Of several reasons to stop, the one with the highest priority is reported.
    priority = 0


class InputError(EngineError):
    """Wrong input: nothing was taken."""


class ConfigError(InputError): ...


class SchemaError(InputError): ...


class UnsupportedType(InputError): ...


class NamingError(InputError): ...


class SerialContractViolation(EngineError):
    priority = 2


class WriterLocked(EngineError): ...


class WriterFenced(EngineError):
    priority = 3


class StorageError(EngineError): ...


class StagedFileLost(EngineError):
    """A file that was staged is there no more: trying again can't help."""


class StagingStalled(EngineError): ...


class RotationFailed(EngineError):
    priority = 1


class StagingOrderViolation(EngineError):
    priority = 4


class DatabaseError(EngineError): ...


class WriterClosed(EngineError): ...


def worst(errors: list[EngineError]) -> EngineError | None:
    """The reason to report when several hold; the first of equals."""
    return max(errors, key=lambda e: e.priority, default=None)
