"""Formats, codecs and lists of files."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..errors import InvalidInput, NoFilesError

#: Names of formats, which are also the files' extensions.
FORMATS = {
    "ttl": "turtle",
    "turtle": "turtle",
    "nq": "nquads",
    "nquads": "nquads",
    "nt": "ntriples",
    "ntriples": "ntriples",
    "trig": "trig",
    "rdf": "rdfxml",
    "xml": "rdfxml",
}
CODECS = (".gz", ".zst")
LINE_FORMATS = ("ntriples", "nquads")


def format_of(path: str, file_type: str | None = None) -> str:
    """The format by name or, without one, by the extension before a codec's."""
    if file_type is not None and file_type.lower() != "auto":
        if file_type.lower() not in FORMATS:
            raise InvalidInput(f"Unknown file_type override: '{file_type}'")
        return FORMATS[file_type.lower()]
    name = path.rsplit("/", 1)[-1].lower()
    for codec in CODECS:
        name = name.removesuffix(codec)
    found = FORMATS.get(name.rpartition(".")[2])
    if found is None:
        raise InvalidInput(f"Unknown file type: '{path}'")
    return found


def files_of(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """The files that a path, a glob or a list of them names, by Hadoop's file systems; sorted within a pattern."""
    jvm, out = spark.sparkContext._jvm, []
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in [paths] if isinstance(paths, str) else list(paths):
        where = jvm.org.apache.hadoop.fs.Path(path)
        system = where.getFileSystem(conf)
        found = [s for s in system.globStatus(where) or []]
        files = []
        for status in found:
            if status.isDirectory():
                files += [s.getPath().toString() for s in system.listStatus(status.getPath()) if s.isFile() and not s.getPath().getName().startswith(("_", "."))]
            else:
                files.append(status.getPath().toString())
        if not files:
            raise NoFilesError(f'IO Error: No files found that match the pattern "{path}"')
        out += sorted(files)
    if not out:
        raise NoFilesError("IO Error: No files found that match an empty list")
    return out


def shown(path: str) -> str:
    """A path as users write it: local ones without their scheme."""
    for prefix in ("file://", "file:"):
        if path.startswith(prefix):
            return path[len(prefix) :]
    return path
