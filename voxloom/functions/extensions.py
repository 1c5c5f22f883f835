"""Where models and own measures, rules and steps are plugged in."""

from __future__ import annotations

import importlib
import pkgutil
import time
import warnings
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from threading import Event

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Step = Callable[[DataFrame], DataFrame]


class Named:
    """A registry of one kind of thing by name."""

    def __init__(self, kind: str) -> None:
        self.kind, self._items = kind, {}

    def add(self, name: str, item: object, replace: bool = False) -> None:
        if name in self._items and not replace:
            raise ValueError(f"{self.kind} {name} is there already")
        self._items[name] = item

    def get(self, name: str) -> object:
        if name not in self._items:
            raise KeyError(f"no {self.kind} named {name}; there are {sorted(self._items)}")
        return self._items[name]

    def names(self) -> list[str]:
        return sorted(self._items)


METRICS, STEPS, MODELS = Named("metric"), Named("step"), Named("model")


def rule_hits(rules: Mapping[str, str]) -> Column:
    """Names, in order, of the rules (SQL conditions) that hold for a row; a null condition doesn't hold."""
    return F.array_compact(F.array(*[F.when(F.expr(condition), F.lit(name)) for name, condition in rules.items()]))


def chain(df: DataFrame, steps: Sequence[Step | tuple[Step, bool]], left_out: list[tuple[str, str]] | None = None) -> DataFrame:
    """Apply steps in turn. A pair (step, True) is optional: if it can't be planned it is left out.

    ``left_out`` gets the name and the error of every step that was left out; without it a warning says so.
    """
    for step in steps:
        call, optional = step if isinstance(step, tuple) else (step, False)
        try:
            df = call(df)
        except Exception as e:
            if not optional:
                raise
            name = getattr(call, "__name__", str(call))
            if left_out is None:
                warnings.warn(f"step {name} is left out: {e}", stacklevel=2)
            else:
                left_out.append((name, str(e)))
    return df


def register_functions(spark: SparkSession, functions: Mapping[str, tuple[Callable, str]]) -> None:
    """Make Python functions known to SQL, as Arrow functions of the given return type."""
    for name, (function, kind) in functions.items():
        spark.udf.register(name, F.pandas_udf(function, kind))


class SlidingWindows:
    """Table function: windows of ``width`` every ``hop`` that lie within a length, as (``segment``, ``start``, ``end``)."""

    def eval(self, length: float, width: float, hop: float):  # noqa: ANN201
        if length is None or not length == length or width <= 0 or hop <= 0:
            return
        k = 0
        while round(k * hop + width, 9) <= length:
            yield k, k * hop, k * hop + width
            k += 1


def register_table_functions(spark: SparkSession) -> None:
    """Make ``sliding_windows(length, width, hop)`` known to SQL, for lateral joins: one row becomes many."""
    spark.udtf.register("sliding_windows", F.udtf(SlidingWindows, returnType="segment int, start double, end double"))


def better_transcript(first: Column, first_confidence: Column, second: Column, second_confidence: Column) -> tuple[Column, Column]:
    """Transcript and confidence of the surer of two models, the first of equals; ``[INAUDIBLE]`` at 0.1 without either.

    Spaces are removed; a text without a confidence counts as 0.5.
    """
    clean = lambda t: F.nullif(F.replace(t, F.lit(" "), F.lit("")), F.lit(""))
    a, b = clean(first), clean(second)
    ca, cb = F.when(a.isNotNull(), F.coalesce(first_confidence, F.lit(0.5))), F.when(b.isNotNull(), F.coalesce(second_confidence, F.lit(0.5)))
    second_wins = b.isNotNull() & (a.isNull() | (cb > ca))
    return F.coalesce(F.when(second_wins, b).otherwise(a), F.lit("[INAUDIBLE]")), F.coalesce(F.when(second_wins, cb).otherwise(ca), F.lit(0.1))


@dataclass
class Task:
    name: str
    run: Callable[[dict], object]
    needs: Sequence[str] = ()
    tries: int = 1
    delay: float = 0.0
    timeout: float | None = None


def load_plugins(package: str) -> list[str]:
    """Import all modules of a package and call ``register()`` of those that have one: the names of these modules, in order.

    A module's ``register`` adds what it brings to :data:`METRICS`, :data:`STEPS` or :data:`MODELS`.
    """
    home = importlib.import_module(package)
    found = []
    for info in sorted(pkgutil.iter_modules(home.__path__, f"{package}."), key=lambda i: i.name):
        module = importlib.import_module(info.name)
        if callable(getattr(module, "register", None)):
            module.register()
            found.append(info.name)
    return found


def run_tasks(
    tasks: Sequence[Task], workers: int = 4, on_event: Callable[[str, str], None] = lambda name, state: None, cancel: Event | None = None
) -> dict[str, tuple[str, object]]:
    """Run tasks when what they need is done: name to (``done``, ``failed``, ``skipped`` or ``cancelled``, result or error).

    Tasks that don't need each other run side by side (their Spark jobs share the session). A task is
    tried again ``tries`` - 1 times, waiting ``delay`` times the try; a try that takes longer than ``timeout`` seconds has failed (what it began is
    not stopped). One whose need is not done is skipped, and when ``cancel`` is set no further try begins. ``on_event`` hears of
    every try and end. A cycle or an unknown need is refused.
    """
    by = {t.name: t for t in tasks}
    if unknown := {n for t in tasks for n in t.needs} - set(by):
        raise ValueError(f"unknown tasks are needed: {sorted(unknown)}")
    out: dict[str, tuple[str, object]] = {}

    def attempt(task: Task) -> object:
        needed = {n: out[n][1] for n in task.needs}
        if task.timeout is None:
            return task.run(needed)
        pool = ThreadPoolExecutor(1)
        try:
            return pool.submit(task.run, needed).result(task.timeout)
        finally:
            pool.shutdown(wait=False)

    def one(task: Task) -> tuple[str, object]:
        if any(out[n][0] != "done" for n in task.needs):
            return "skipped", None
        error: BaseException | None = None
        for k in range(1, task.tries + 1):
            if cancel is not None and cancel.is_set():
                return "cancelled", error
            on_event(task.name, "started" if k == 1 else "retried")
            try:
                return "done", attempt(task)
            except Exception as e:  # noqa: BLE001
                error = e
                if k < task.tries:
                    time.sleep(task.delay * k)
        return "failed", error

    with ThreadPoolExecutor(workers) as pool:
        while len(out) < len(by):
            ready = [t for t in tasks if t.name not in out and all(n in out for n in t.needs)]
            if not ready:
                raise ValueError("tasks need each other in a circle")
            for task, result in zip(ready, pool.map(one, ready), strict=True):
                out[task.name] = result
                on_event(task.name, result[0])
    return out
