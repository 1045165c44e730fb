"""Files in the shared folder that tasks read and write themselves.

``spark.checkpoint.dir`` may be a path or a URI. pyarrow reaches local and mounted folders and,
where their client libraries are installed, HDFS and object stores.
"""

from __future__ import annotations

from pyarrow import fs


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = path.removeprefix("file:")  # Java writes file:/folder
    return fs.FileSystem.from_uri(path)


def parquet_files(folder: str) -> list[str]:
    """Paths, within their file system, of the Parquet files directly in a folder."""
    system, at = located(folder)
    found = system.get_file_info(fs.FileSelector(at))
    return sorted(f.path for f in found if f.is_file and f.base_name.endswith(".parquet"))
