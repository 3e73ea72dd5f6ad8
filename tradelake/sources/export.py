"""Normalised form of one landed export.

A source export is a list of nested documents.  We keep it as one flat frame
per nesting path instead of one nested row per document:

* ``""``                -> the documents, ordered by ``_ord``
* ``"order_products"``  -> one row per list element, ``(_ord, _p1)`` points at
  the document and the element position
* ``"order_products.details"`` -> ``(_ord, _p1, _p2)`` and so on.

The reference columns (``refs``) give record order for keep-first
de-duplication.  A frame of nested documents also holds its child lists as
array columns (``lists``): children are then exploded from the parent rows that
survive, in place, without a join.  Frames derived from separate relational
tables have no such list; there the references are the join key between a
child and its parent, and no step groups an unbounded list into one row.  Such a
frame may also give the ``source`` rows that it is a projection of: a join with
the parent then moves those, and the text is made from the rows it keeps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, MutableMapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Frame:
    df: DataFrame
    refs: tuple[str, ...]          # _ord + position column(s) of every level
    lists: tuple[str, ...] = ()    # array columns: the frame's child lists
    source: DataFrame | None = None                         # the rows that df is a projection of
    exprs: dict[str, str] = field(default_factory=dict)     # column of df -> its SQL over source

    def parent_refs(self, depth: int) -> tuple[str, ...]:
        """Reference columns of the ancestor at ``depth`` (0 = document)."""
        return self.refs[: ref_width(self.refs, depth)]


def ref_width(refs: tuple[str, ...], depth: int) -> int:
    """Number of leading ref columns that identify a row at ``depth``.

    Ref columns are named ``_ord`` / ``_ord_<x>`` (depth 0) and ``_p{k}`` /
    ``_p{k}_<x>`` (depth k); a level may use several columns for its position."""
    n = 0
    for r in refs:
        lvl = 0 if r.startswith("_ord") else int(r[2:].split("_")[0])
        if lvl <= depth:
            n += 1
    return n


def path_depth(path: str) -> int:
    return 0 if path == "" else path.count(".") + 1


class FrameMap(MutableMapping):
    """Frames by nesting path.  A frame may be registered as a factory
    (:meth:`defer`) and is then built on first use, so a query that needs two
    of an export's fifteen paths only defines (and analyses) those two."""

    def __init__(self) -> None:
        self._built: dict[str, Frame] = {}
        self._pending: dict[str, Callable[[], Frame]] = {}

    def defer(self, path: str, make: Callable[[], Frame]) -> None:
        self._built.pop(path, None)
        self._pending[path] = make

    def __getitem__(self, path: str) -> Frame:
        if path not in self._built:
            self._built[path] = self._pending.pop(path)()      # KeyError when unknown
        return self._built[path]

    def __setitem__(self, path: str, fr: Frame) -> None:
        self._pending.pop(path, None)
        self._built[path] = fr

    def __delitem__(self, path: str) -> None:
        if self._built.pop(path, None) is None:
            del self._pending[path]

    def __iter__(self) -> Iterator[str]:
        return iter([*self._built, *self._pending])

    def __len__(self) -> int:
        return len(self._built) + len(self._pending)


@dataclass
class Export:
    """All frames of one export, keyed by nesting path."""
    name: str
    frames: FrameMap = field(default_factory=FrameMap)

    def frame(self, path: str) -> Frame:
        try:
            return self.frames[path]
        except KeyError:
            raise KeyError(f"export {self.name!r} has no path {path!r}; "
                           f"known: {sorted(self.frames)}") from None
