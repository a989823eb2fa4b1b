"""What can go wrong, as exceptions."""


class KeyspaceError(Exception):
    """Base of all."""


class InvalidInput(KeyspaceError, ValueError):
    """An argument that means nothing here."""


class InvalidPath(InvalidInput):
    """A table without a folder."""


class SchemaMismatch(InvalidInput):
    """A type that a field can't be read as."""


class KeyExists(KeyspaceError, ValueError):
    """A name that is taken."""


class IndexNotFound(KeyspaceError, LookupError):
    """No index of that name."""


class TypeConflict(KeyspaceError, TypeError):
    """A table holds another shape than the one written."""


class VersionConflict(KeyspaceError):
    """Another writer has saved a version since the one that was read."""
