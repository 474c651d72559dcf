"""Running stages whose outputs are kept, with a ledger of what each was made from.

A stage's fingerprint is a digest of its function's code and parameters, of its version, of the files of its inputs (names, sizes, times) and of the
fingerprints of the stages before it. A stage runs again if its fingerprint is not the one in the ledger. Its output goes to a folder of its own first
and counts only once the ledger names that folder; the ledger's entry is written beside and moved into place, so what a lost driver leaves half
written is never read. Prerequisites of all stages are checked before any runs.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from types import CodeType

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Stage:
    name: str
    needs: tuple[str, ...]
    function: Callable[..., DataFrame]  # of the needed stages' outputs and, by name, of the parameters
    parameters: dict = field(default_factory=dict)
    inputs: tuple[str, ...] = ()  # files or folders that the function reads by itself
    version: str = ""  # changed by hand where functions that the stage calls have changed


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _folder(spark, path)
    return fs.exists(p)


def _code(code: CodeType) -> list:
    consts = [_code(c) if isinstance(c, CodeType) else sorted(map(repr, c)) if isinstance(c, frozenset) else repr(c) for c in code.co_consts]
    return [code.co_code.hex(), consts, list(code.co_names), list(code.co_varnames)]


def code_digest(function: Callable) -> str:
    """Of a function's code, defaults and closure; functions that it calls count by their names, and what can change in place by its type."""
    inner = getattr(function, "__wrapped__", function)
    plain = lambda x: repr(x) if isinstance(x, (str, int, float, bool, bytes, tuple, type(None))) else getattr(x, "__qualname__", type(x).__qualname__)
    cells = [plain(c.cell_contents) for c in getattr(inner, "__closure__", None) or ()]
    code = getattr(inner, "__code__", None)
    said = [getattr(inner, "__qualname__", ""), _code(code) if code else "", list(map(plain, getattr(inner, "__defaults__", None) or ())), cells]
    return hashlib.sha256(json.dumps(said).encode()).hexdigest()


def input_digest(spark: SparkSession, path: str) -> str:
    """Of the names, sizes and times of the files at a path; what begins with an underscore or a dot does not count."""
    p, fs = _folder(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    files, found = fs.listFiles(p, True), []
    while files.hasNext():
        f = files.next()
        if f.getPath().getName()[0] not in "_.":
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hashlib.sha256(json.dumps(sorted(found)).encode()).hexdigest()


def _ledger(spark: SparkSession, root: str, name: str) -> dict | None:
    p, fs = _folder(spark, f"{root}/_ledger/{name}.json")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _commit(spark: SparkSession, root: str, name: str, entry: dict) -> None:
    at, fs = _folder(spark, f"{root}/_ledger/{name}.json")
    new, _ = _folder(spark, f"{root}/_ledger/.{name}-{uuid.uuid4().hex}")
    stream = fs.create(new)
    stream.write(bytearray(json.dumps(entry, indent=1).encode()))
    stream.close()
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    modes = spark._sc._gateway.new_array(rename, 1)
    modes[0] = rename.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri() if at.toUri().getScheme() else fs.getUri(), spark._jsparkSession.sessionState().newHadoopConf())
    context.rename(new, at, modes)


def run(spark: SparkSession, root: str, stages: list[Stage | tuple[str, list[str], Callable[..., DataFrame]]], resume: bool = True) -> dict[str, DataFrame]:
    """The outputs of stages, below root; a stage is made again if anything it is made from has changed, or if resume is off.

    Stages need only stages before them, and inputs must be there; else nothing runs. Output of an earlier fingerprint goes once its successor counts.
    """
    plan = [s if isinstance(s, Stage) else Stage(s[0], tuple(s[1]), s[2]) for s in stages]
    known: set[str] = set()
    for s in plan:
        if missing := [n for n in s.needs if n not in known]:
            raise ValueError(f"stage {s.name} needs {', '.join(missing)} first")
        if s.name in known or not s.name.strip("_."):
            raise ValueError(f"stage name {s.name!r} is taken or empty")
        if missing := [p for p in s.inputs if not exists(spark, p)]:
            raise FileNotFoundError(f"stage {s.name} needs {', '.join(missing)}")
        known.add(s.name)
    done: dict[str, DataFrame] = {}
    prints: dict[str, str] = {}
    for s in plan:
        made_from = {
            "code": code_digest(s.function), "parameters": json.dumps(s.parameters, sort_keys=True, default=repr), "version": s.version,
            "inputs": {p: input_digest(spark, p) for p in s.inputs}, "stages": {n: prints[n] for n in s.needs},
        }
        prints[s.name] = hashlib.sha256(json.dumps(made_from, sort_keys=True).encode()).hexdigest()
        entry = _ledger(spark, root, s.name)
        if not (resume and entry and entry["fingerprint"] == prints[s.name] and exists(spark, f"{root}/{entry['folder']}/_SUCCESS")):
            folder = f"{s.name}/{prints[s.name][:16]}-{uuid.uuid4().hex[:8]}"
            s.function(*(done[n] for n in s.needs), **s.parameters).write.parquet(f"{root}/{folder}")
            old, entry = entry, {"fingerprint": prints[s.name], "folder": folder, "made_from": made_from}
            _commit(spark, root, s.name, entry)
            if old and old["folder"] != folder:
                p, fs = _folder(spark, f"{root}/{old['folder']}")
                fs.delete(p, True)
        done[s.name] = spark.read.parquet(f"{root}/{entry['folder']}")
    return done
