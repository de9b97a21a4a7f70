"""Runs of numbered batches that merge in any order, for the stop rule's state."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass
class Run:
    """Batches first..last, all of them seen. Places in a run count from 1.

    prefix, suffix: low yields in a row at its start and end. streaks: (from, to) of other rows of low yields of at least
    n_low, as far as they can matter: none follows one that reaches place min_batches, as that one stops sooner.
    """

    first: int
    last: int
    prefix: int
    suffix: int
    streaks: list[tuple[int, int]] = field(default_factory=list)

    @property
    def rows(self) -> int:
        return self.last - self.first + 1


def join(a: Run, b: Run, n_low: int, min_batches: int) -> Run:
    """Run a and run b that starts right after it."""
    all_a, all_b = a.prefix == a.rows, b.prefix == b.rows
    streaks = [s for s in a.streaks if s[1] < a.rows]
    if not all_a and a.suffix + b.prefix >= n_low:
        streaks.append((a.rows - a.suffix + 1, a.rows + b.prefix))
    streaks += [(s + a.rows, e + a.rows) for s, e in b.streaks]
    enough = next((i for i, s in enumerate(streaks) if s[1] >= min_batches), len(streaks))
    return Run(a.first, b.last, a.prefix + b.prefix if all_a else a.prefix, b.suffix + a.suffix if all_b else b.suffix, streaks[: enough + 1])


def add(runs: dict[int, Run], batch: int, low: bool, n_low: int, min_batches: int) -> bool:
    """Put a batch among runs (by first); False if it was there. Neighbours become one run."""
    if any(r.first <= batch <= r.last for r in runs.values()):
        return False
    run = Run(batch, batch, int(low), int(low))
    left = next((r for r in runs.values() if r.last == batch - 1), None)
    if left:
        run = join(runs.pop(left.first), run, n_low, min_batches)
    right = runs.pop(batch + 1, None)
    if right:
        run = join(run, right, n_low, min_batches)
    runs[run.first] = run
    return True


def stop(runs: dict[int, Run], n_low: int, min_batches: int) -> int | None:
    """The first batch, in order, with n_low low yields in a row that is the min_batches-th or a later one."""
    before = carried = 0
    for first in sorted(runs):
        r = runs[first]
        at = max(n_low - carried, min_batches - before, 1)
        if at <= r.prefix:
            return r.first + at - 1
        for s, e in r.streaks:
            at = max(s + n_low - 1, min_batches - before)
            if at <= e:
                return r.first + at - 1
        before += r.rows
        carried = carried + r.rows if r.prefix == r.rows else r.suffix
    return None
