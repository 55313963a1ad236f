"""Array files in the shared folder of spark.checkpoint.dir, written by tasks and memory-mapped by workers.

A local or mounted folder is mapped in place. From any other store (through pyarrow's
file systems) a worker copies a file to its own temporary folder once, maps the copy and
unlinks it, so that nothing is left behind.
"""

from __future__ import annotations

import json
import mmap
import os
import tempfile
import uuid

import numpy as np


def _local(uri: str) -> str | None:
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    return uri if "://" not in uri else None


def write_arrays(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """One file of named arrays; a task that runs twice leaves the same file, a broken one none."""
    head = json.dumps([[k, v.dtype.str, len(v)] for k, v in arrays.items()]).encode()
    head += b" " * (-(len(head) + 8) % 64)
    data = [len(head).to_bytes(8, "little"), head]
    for v in arrays.values():
        data += [v.tobytes(), b"\0" * (-v.nbytes % 64)]
    path = _local(folder)
    if path is None:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        own = f"{base}/.{name}-{uuid.uuid4().hex}"
        with store.open_output_stream(own) as f:
            for d in data:
                f.write(d)
        store.move(own, f"{base}/{name}")
        return
    os.makedirs(path, exist_ok=True)
    own = f"{path}/.{name}-{uuid.uuid4().hex}"
    with open(own, "wb") as f:
        f.writelines(data)
    os.replace(own, f"{path}/{name}")


def map_arrays(folder: str, name: str) -> dict[str, np.ndarray]:
    """The arrays of a file, mapped read-only. A file that is not there raises: callers know which were written."""
    path = _local(folder)
    if path is None:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        with tempfile.NamedTemporaryFile() as copy, store.open_input_stream(f"{base}/{name}") as f:
            while part := f.read(1 << 22):
                copy.write(part)
            copy.flush()
            held = mmap.mmap(copy.fileno(), 0, access=mmap.ACCESS_READ)
    else:
        with open(f"{path}/{name}", "rb") as f:
            held = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    size = int.from_bytes(held[:8], "little")
    out, at = {}, 8 + size
    for k, kind, n in json.loads(held[8:8 + size]):
        out[k] = np.frombuffer(held, np.dtype(kind), n, at)
        at += -(-out[k].nbytes // 64) * 64
    return out
