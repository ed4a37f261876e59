"""Preparation runs: steps over named tables, with reusable checkpoints.

A step is a function ``DataFrame -> DataFrame`` with its arguments and the names
of the tables it works on. Steps compose one lazy plan; nothing runs until a
checkpoint or a sink needs it.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from types import ModuleType
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession

from ragtables.sources import storage

# Fixed value: the table that a step works on if it names none.
MAIN = "main_dataset"


@dataclass(frozen=True)
class Step:
    """One step.

    ``fn`` gets the table and ``params``. With ``whole=True`` it gets the dict of
    all tables instead of one, and returns the tables to add or replace - for
    loaders, merges and other steps that read several tables. ``outputs`` names
    what such a step makes, if not its inputs. ``keep=False`` leaves the step out
    of the checkpoints.
    """

    fn: Callable[..., Any]
    inputs: str | Sequence[str] = (MAIN,)
    params: Mapping[str, Any] = field(default_factory=dict)
    whole: bool = False
    outputs: Sequence[str] = ()
    keep: bool = True

    def names(self) -> list[str]:
        names = [self.inputs] if isinstance(self.inputs, str) else list(self.inputs)
        if not names:
            raise ValueError("a step needs at least one input")
        return names

    def targets(self) -> list[str]:
        return list(self.outputs) or self.names()

    def run(self, frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        if not self.whole:
            return {n: self.fn(frames[n], **self.params) for n in self.names()}
        made = self.fn(frames, **self.params)
        if sorted(made) != sorted(self.targets()):
            raise ValueError(f"step made {sorted(made)}, expected {self.targets()}")
        return dict(made)


def describe(value: Any, seen: tuple[int, ...] = ()) -> Any:
    """A JSON value that stands for a step parameter.

    Functions count with their code, their defaults, what they enclose and the module
    globals that they name, tables with their plan's sources; anything else without a JSON form is refused, because two
    different steps must never share a fingerprint.
    """
    if isinstance(value, DataFrame):
        return source_identity(value)
    if isinstance(value, Column):
        return ["column", str(value)]
    if isinstance(value, SparkSession):
        return ["session"]
    if isinstance(value, Mapping):
        return {str(k): describe(v, seen) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [describe(v, seen) for v in value]
    if isinstance(value, (str, int, float, bool, type(None))):
        return value
    if hasattr(value, "func") and hasattr(value, "keywords"):
        parts = (value.func, value.args, value.keywords)
        return ["partial", *[describe(v, seen) for v in parts]]
    if isinstance(value, type):
        members = {n: v for n, v in vars(value).items() if hasattr(v, "__code__")}
        return ["class", value.__module__, value.__qualname__, describe(members, seen)]
    if hasattr(value, "tobytes"):
        return ["array", list(value.shape), hashlib.md5(value.tobytes()).hexdigest()]
    code = getattr(value, "__code__", None)
    if code is None:
        raise TypeError(f"cannot fingerprint {value!r}")
    name = [value.__module__, value.__qualname__]
    if id(value) in seen:  # functions that call each other
        return ["function", *name]
    seen = (*seen, id(value))
    cells = [describe(c.cell_contents, seen) for c in value.__closure__ or ()]
    defaults = [describe(value.__defaults__, seen), describe(value.__kwdefaults__, seen)]
    return ["function", *name, *_code(code), cells, *defaults, _globals(value, seen)]


def _names(code: Any) -> set[str]:
    nested = [_names(c) for c in code.co_consts if hasattr(c, "co_code")]
    return set(code.co_names).union(*nested)


def _globals(function: Any, seen: tuple[int, ...]) -> dict[str, Any]:
    """What a function's global names stand for. Modules and imported libraries'
    functions and classes count by name."""
    home = function.__module__.partition(".")[0]
    out: dict[str, Any] = {}
    for name in sorted(_names(function.__code__) & set(function.__globals__)):
        value = function.__globals__[name]
        module = getattr(value, "__module__", None) or ""
        if isinstance(value, ModuleType):
            out[name] = ["module", value.__name__]
        elif callable(value) and module.partition(".")[0] != home:
            out[name] = ["library", module, getattr(value, "__qualname__", name)]
        else:
            try:
                out[name] = describe(value, seen)
            except TypeError:
                # No JSON form: another such value is told by its pickled form.
                out[name] = ["pickle", hashlib.md5(cloudpickle.dumps(value)).hexdigest()]
    return out


def _code(code: Any) -> list[Any]:
    nested = [_code(c) if hasattr(c, "co_code") else repr(c) for c in code.co_consts]
    return [code.co_code.hex(), list(code.co_names), nested]


def source_identity(df: DataFrame) -> list[Any]:
    """Schema, plan and input files of a table.

    A file counts with its path, length and time. Expression ids
    differ from session to session and are left out. A table that is not read from
    files has no identity beyond its session.
    """
    execution = df._jdf.queryExecution()
    plan = execution.analyzed().treeString(True, False, 2**31 - 1, False, False)
    plan = re.sub(r"#\d+L?", "", plan)
    state = storage.file_states(df) or df.semanticHash()
    return ["table", df.schema.json(), plan, state]


def fingerprint(*parts: Any) -> str:
    text = json.dumps([describe(p) for p in parts], sort_keys=True)
    return hashlib.md5(text.encode()).hexdigest()


class Checkpoints:
    """Step results kept as parquet under ``base/name/position-step/fingerprint/table``.

    ``base`` defaults to the cluster's shared folder.
    """

    def __init__(self, spark: SparkSession, name: str, base: str | None = None):
        self.spark = spark
        self.root = f"{(base or storage.shared_dir(spark)).rstrip('/')}/{name}"

    def path(self, position: int, step: Step, mark: str, table: str) -> str:
        kind = getattr(step.fn, "__name__", "step").strip("<>")
        return f"{self.root}/{position}-{kind}/{mark}/{table}"

    def complete(self, paths: Mapping[str, str]) -> bool:
        return all(storage.is_complete(self.spark, p) for p in paths.values())

    def load(self, paths: Mapping[str, str]) -> dict[str, DataFrame]:
        return {n: self.spark.read.parquet(p) for n, p in paths.items()}

    def save(self, made: Mapping[str, DataFrame], paths: Mapping[str, str]) -> None:
        for name, path in paths.items():
            made[name].write.mode("overwrite").parquet(path)

    def delete(self) -> bool:
        """Remove all results of this run."""
        return storage.delete(self.spark, self.root)


def run_steps(
    frames: Mapping[str, DataFrame],
    steps: Sequence[Step],
    checkpoints: Checkpoints | None = None,
) -> dict[str, DataFrame]:
    """Run the steps in order and return all tables.

    With checkpoints, a step's result is written and read back, which also cuts
    the plan. It is reused when it is complete, its fingerprint - the step, its
    parameters, and the same of everything upstream, down to the source files -
    is the same, and no earlier step had to be computed in this run.
    """
    frames = dict(frames)
    marks = {n: fingerprint(f) for n, f in frames.items()} if checkpoints else {}
    recomputed = False
    for position, step in enumerate(steps):
        if checkpoints is None:
            frames.update(step.run(frames))
            continue
        upstream = {n: marks.get(n) for n in (marks if step.whole else step.names())}
        mark = fingerprint(step.fn, step.params, step.targets(), upstream)
        paths = {
            n: checkpoints.path(position, step, mark, n) for n in step.targets()
        }
        if step.keep and not recomputed and checkpoints.complete(paths):
            made = checkpoints.load(paths)
        else:
            made = step.run(frames)
            if step.keep:
                checkpoints.save(made, paths)
                made = checkpoints.load(paths)
                recomputed = True
        for name, frame in made.items():
            # What a loader reads counts as well, not only what it was told.
            own = [] if step.keep else [source_identity(frame)]
            marks[name] = fingerprint(mark, name, own)
        frames.update(made)
    return frames
