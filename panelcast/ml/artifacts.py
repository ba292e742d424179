"""Trained artefacts in the shared folder, published whole or not at all.

An artefact is named by a key over its inputs, its parameters and the version
of the code that makes it. Every run writes into a folder of its own; a
pointer file that is moved into place in one step names the run that counts.
Readers follow the pointer only, so they never see a run that is being written,
and two runs of one key at the same time do not touch each other: one of them is named.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Callable

from pyarrow import fs

POINTER = "current"


def code_version() -> str:
    """A digest of the library's sources that models come from."""
    here = os.path.dirname(os.path.abspath(__file__))
    digest = hashlib.sha256()
    for folder in (here, os.path.join(os.path.dirname(here), "operators")):
        for name in sorted(os.listdir(folder)):
            if name.endswith(".py"):
                with open(os.path.join(folder, name), "rb") as f:
                    digest.update(name.encode() + b"\0" + f.read())
    return digest.hexdigest()[:16]


def artefact_key(inputs: str, parameters: dict) -> str:
    text = json.dumps([inputs, parameters, code_version()], sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()[:24]


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))


def published(root: str, key: str) -> str | None:
    """Folder of the run that counts, or None."""
    system, base = _open(f"{root}/{key}")
    at = f"{base}/{POINTER}"
    if system.get_file_info(at).type != fs.FileType.File:
        return None
    with system.open_input_stream(at) as f:
        return f"{root}/{key}/{f.read().decode()}"


def publish(root: str, key: str, run: str) -> str:
    """Make ``run`` (a folder name under the key) the one that counts, unless another is; returns the one that counts."""
    system, base = _open(f"{root}/{key}")
    own = f"{base}/.{POINTER}-{uuid.uuid4().hex}"
    with system.open_output_stream(own) as f:
        f.write(run.encode())
    if published(root, key) is None:
        try:
            system.move(own, f"{base}/{POINTER}")
        except OSError:  # another run was named in between, where a move does not replace
            if published(root, key) is None:
                raise
    else:
        system.delete_file(own)
    return published(root, key)


def artefact(root: str, key: str, make: Callable[[str], None]) -> str:
    """Folder of the published run; ``make(folder)`` writes one if there is none."""
    found = published(root, key)
    if found:
        return found
    run = f"run-{uuid.uuid4().hex}"
    system, base = _open(f"{root}/{key}")
    system.create_dir(f"{base}/{run}", recursive=True)
    make(f"{root}/{key}/{run}")
    return publish(root, key, run)
