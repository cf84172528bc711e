"""Errors of the package."""


class RdfError(Exception):
    """Base of all errors raised here."""


class RdfSyntaxError(RdfError):
    """A document that breaks its format's grammar."""

    def __init__(self, what: str, file: str = "", line: int = 0, column: int = 0):
        super().__init__(f"Syntax Error: '{what}' in '{file}', at line {line}, column {column}")
        self.what, self.file, self.line, self.column = what, file, line, column

    def __reduce__(self):
        return type(self), (self.what, self.file, self.line, self.column)


class NoFilesError(RdfError, FileNotFoundError):
    """No file matches a pattern."""


class InvalidInput(RdfError, ValueError):
    """An argument out of range."""


class MappingError(RdfError):
    """A mapping that can't be read or isn't valid."""


class SparqlParseError(RdfError):
    """A query that breaks SPARQL's grammar."""

    def __init__(self, what: str, line: int, column: int, near: str):
        super().__init__(f"SPARQL parse error: {what} (line {line}, column {column}, near '{near}')")


class TranslationError(RdfError):
    """A query outside of what can be translated."""

    def __init__(self, what: str):
        super().__init__(f"SPARQL-to-SQL translation error: {what}")
