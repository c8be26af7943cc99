"""Several outputs of shared intermediates: one plan each, or one pass for all."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from .cache import reliable_checkpoint


class Frames(Mapping):
    """Intermediates by name, each built on first access from those before it.

    ``held`` says whether they are kept (persisted or checkpointed), so that an
    output may read one that it would not build for itself alone.
    """

    def __init__(self, stages: Mapping[str, Callable[["Frames"], DataFrame]], held: bool = False):
        self._stages, self.held = stages, held
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._stages[name](self)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._stages)

    def __len__(self) -> int:
        return len(self._stages)

    def keep(self, how: Callable[[DataFrame], DataFrame]) -> None:
        for name in self:
            self._built[name] = how(self[name])


class Outputs(Mapping):
    """Named pipeline outputs derived from small shared intermediates.

    ``stages`` maps each intermediate that several outputs read to a function
    building it from the intermediates before it; ``derive`` gives the outputs
    as functions of all of them, called on first access only (a caller reading
    one output does not plan the others). Without ``with`` each output is an
    independent lazy plan. Inside ``with`` every intermediate is persisted once
    (default), or, after ``checkpointed()``, written to the reliable
    ``spark.checkpoint.dir`` with its lineage cut, so losing an executor
    while the outputs are written never re-runs the fact scan. ``shared`` has the
    intermediates' lazy plans.
    """

    def __init__(self, stages: Mapping[str, Callable[[Frames], DataFrame]],
                 derive: Callable[[Frames], dict[str, Callable[[], DataFrame]]]):
        self._stages = dict(stages)
        self._derive = derive
        self.shared = Frames(self._stages)
        self._outputs = derive(self.shared)
        self._built: dict[str, DataFrame] = {}
        self._held: Frames | None = None
        self._reliable = False

    def checkpointed(self) -> "Outputs":
        """Use reliable checkpoints instead of ``persist`` inside ``with``."""
        self._reliable = True
        return self

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._outputs[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._outputs)

    def __len__(self) -> int:
        return len(self._outputs)

    def _use(self, frames: Frames) -> None:
        self._outputs, self._built = self._derive(frames), {}

    def __enter__(self) -> "Outputs":
        self._held = Frames(self._stages, held=True)
        self._held.keep(reliable_checkpoint if self._reliable
                        else lambda frame: frame.persist(StorageLevel.MEMORY_AND_DISK))
        self._use(self._held)
        return self

    def __exit__(self, *exc) -> None:
        if not self._reliable:
            for name in self._held:
                self._held[name].unpersist()
        self._held = None
        self._use(self.shared)
