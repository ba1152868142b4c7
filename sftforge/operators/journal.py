"""A journal of generated batches, so that a lost task repeats one batch.

Generation is the one step whose work is dear.  A task writes each batch's
answers to the journal as soon as it has them, one small file named by a digest
of the options and prompts; a retried task, or a later run, finds the batches
done before and generates the others only.  Files appear whole: they are written
under another name and moved.  The journal lies in storage that all tasks see
(any that ``pyarrow.fs`` opens) and may be deleted once the output is committed.
"""

from __future__ import annotations

import hashlib
import json
import uuid


class Journal:
    def __init__(self, uri: str):
        from pyarrow import fs

        if uri.startswith("file:/") and not uri.startswith("file://"):
            uri = uri[len("file:"):]
        self.fs, self.root = fs.FileSystem.from_uri(uri)
        self._made: set[str] = set()

    @staticmethod
    def key(options: dict, prompts: list) -> str:
        said = json.dumps([options, prompts], sort_keys=True, ensure_ascii=True, default=str)
        return hashlib.sha256(said.encode()).hexdigest()

    def _path(self, key: str) -> str:
        return f"{self.root}/{key[:2]}/{key}.json"

    def get(self, key: str) -> list[str | None] | None:
        """The batch's answers, or None if it wasn't finished."""
        try:
            with self.fs.open_input_stream(self._path(key)) as f:
                return json.loads(f.read().decode())
        except FileNotFoundError:
            return None

    def put(self, key: str, answers: list) -> None:
        path = self._path(key)
        if key[:2] not in self._made:
            self.fs.create_dir(f"{self.root}/{key[:2]}", recursive=True)
            self._made.add(key[:2])
        temporary = f"{path}.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(temporary) as f:
            f.write(json.dumps(answers, ensure_ascii=True).encode())
        self.fs.move(temporary, path)
