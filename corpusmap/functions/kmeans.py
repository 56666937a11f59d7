"""Clustering arithmetic on the rows of one task."""

from __future__ import annotations

import zlib

import numpy as np


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Index of the closest centre for each row."""
    return np.argmin((centres**2).sum(1) - 2.0 * (x @ centres.T), axis=1)


# Rounds in which candidates for the first centres are drawn, and how many of them per centre and round.
DRAW_ROUNDS = 2
DRAWS_PER_CENTRE = 2
# Rows of a batch, and batches drawn from a node: the centres of a larger node come from that many rows and one
# pass over all of them.
BATCH_DOCS = 1024
BATCHES = 48
BATCH_TURN = 10_000
# Squared shift of all centres, as a share of their squared length, that ends the improvement: what is
# left when no row moves but sums are added up in another order.
STILL = 1e-16


def draws(ids: np.ndarray, seed: int, name: str, turn: int) -> np.ndarray:
    """One exponential draw per row. It depends on the row's id and the names only, so a node of any size
    and any partitioning has the same draws."""
    salt = np.uint64(zlib.crc32(f"{seed}/{name}/{turn}".encode())) << np.uint64(32)
    z = ids.astype(np.uint64) ^ salt
    with np.errstate(over="ignore"):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 0x9E3779B97F4A7C15)):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return -np.log(((z >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53)


def gaps(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distance of each row to its nearest centre; 1 without centres."""
    if not len(centres):
        return np.ones(len(x))
    best = np.full(len(x), np.inf)
    for centre in centres:
        np.minimum(best, ((x - centre) ** 2).sum(1), out=best)
    return best


def first_drawn(ids: np.ndarray, x: np.ndarray, weights: np.ndarray, turn_draws: np.ndarray, n: int) -> np.ndarray:
    """Places of ``n`` rows drawn without repeats with chances as their weights: the smallest draw per
    weight wins. The winners of all rows are among the winners of any parts of them."""
    with np.errstate(divide="ignore"):
        race = np.where(weights > 0, turn_draws / weights, np.inf)
    order = np.lexsort((ids, race))[:n]
    return order[np.isfinite(race[order])]


def pick_centres(ids: np.ndarray, x: np.ndarray, weights: np.ndarray, k: int, seed: int, name: str) -> np.ndarray:
    """``k`` of the weighted candidates, each drawn with weight times squared distance to those before."""
    chosen: list[int] = []
    for turn in range(k):
        near = gaps(x, x[chosen]) * weights
        found = first_drawn(ids, x, near, draws(ids, seed, name, 100 + turn), 1)
        if not len(found):
            break
        chosen.append(int(found[0]))
    return x[chosen]


def starting_centres(ids: np.ndarray, x: np.ndarray, k: int, seed: int, name: str) -> np.ndarray:
    """First centres of a node from its drawn rows. Candidates are drawn from all rows in a few rounds, each time by their distance to the
    candidates so far, and weighted with the rows that are nearest to them."""
    found = first_drawn(ids, x, np.ones(len(x)), draws(ids, seed, name, 0), 1)
    for turn in range(1, DRAW_ROUNDS + 1):
        more = first_drawn(ids, x, gaps(x, x[found]), draws(ids, seed, name, turn), DRAWS_PER_CENTRE * k)
        found = np.concatenate([found, more])
    found = found[np.argsort(ids[found])]
    weights = np.bincount(nearest(x, x[found]), minlength=len(found))
    return pick_centres(ids[found], x[found], weights, k, seed, name)


def slot_sums(x: np.ndarray, labels: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row counts and vector sums per label."""
    counts = np.bincount(labels, minlength=k)
    member = np.zeros((k, len(x)))
    member[labels, np.arange(len(x))] = 1.0
    return counts, member @ x


def improve(x: np.ndarray, centres: np.ndarray, max_iter: int) -> tuple[np.ndarray, np.ndarray]:
    """Lloyd steps until the centres rest; an empty cluster keeps its centre."""
    for _ in range(max_iter):
        counts, sums = slot_sums(x, nearest(x, centres), len(centres))
        filled = counts > 0
        old, centres = centres, centres.copy()
        centres[filled] = sums[filled] / counts[filled, None]
        if ((centres - old) ** 2).sum() <= STILL * max((old**2).sum(), 1e-12):
            break
    return centres, nearest(x, centres)


def batch_rows(ids: np.ndarray, seed: int, name: str) -> np.ndarray:
    """Places of the rows that the batches of a node are cut from, in the order of their draws."""
    race = draws(ids, seed, name, BATCH_TURN)
    order = np.lexsort((ids, race))
    return order[: BATCH_DOCS * BATCHES]


def batch_bound(n: float) -> float:
    """A draw that the rows of all batches stay under in a node of ``n`` rows, but for a chance below 1e-20."""
    wanted = BATCH_DOCS * BATCHES
    chance = (wanted + 10 * np.sqrt(wanted)) / n
    return float("inf") if chance >= 1 else float(-np.log1p(-chance))


def mini_batches(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Centres after each batch of rows has moved them, each at a rate that falls with the rows it has had."""
    centres, seen = centres.copy(), np.zeros(len(centres))
    for a in range(0, len(x), BATCH_DOCS):
        batch = x[a : a + BATCH_DOCS]
        counts, sums = slot_sums(batch, nearest(batch, centres), len(centres))
        seen += counts
        filled = counts > 0
        centres[filled] += (sums[filled] - counts[filled, None] * centres[filled]) / seen[filled, None]
    return centres


def trained(ids: np.ndarray, x: np.ndarray, centres: np.ndarray, max_iter: int, seed: int, name: str) -> np.ndarray:
    """Centres of the drawn rows: moved batch by batch, then at rest on all drawn rows."""
    return improve(x, mini_batches(x[batch_rows(ids, seed, name)], centres), max_iter)[0]


def settled(counts: np.ndarray, sums: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Centres as the means of all rows nearest to them; in single precision, so that the order in which the
    rows were added up does not show."""
    moved = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return moved.astype(np.float32).astype(np.float64)


def fit(ids: np.ndarray, x: np.ndarray, k: int, max_iter: int, seed: int, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(centres, labels) of a node whose rows are all here; ``clustering.train`` finds the same centres for a node
    spread over a table."""
    some = np.sort(batch_rows(ids, seed, name))
    centres = starting_centres(ids[some], x[some], k, seed, name)
    centres = trained(ids[some], x[some], centres, max_iter, seed, name)
    if len(some) < len(ids):
        centres = settled(*slot_sums(x, nearest(x, centres), len(centres)), centres)
    return centres, nearest(x, centres)


def unit_rows(x: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norms, out=np.zeros_like(x), where=norms > 0)


def silhouettes(unit: np.ndarray, labels: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Exact cosine silhouette of each row from the count and unit-vector sum of every cluster.

    The mean distance of x to a cluster is 1 - x.S/n; within its own cluster x itself is left out.
    Rows alone in their cluster score 0.
    """
    own = counts[labels]
    dots = unit @ sums.T
    rows = np.arange(len(unit))
    self_dot = (unit * unit).sum(1)
    with np.errstate(divide="ignore", invalid="ignore"):
        inside = (own - dots[rows, labels] - (1.0 - self_dot)) / (own - 1)
        between = np.where(counts > 0, 1.0 - dots / counts, np.inf)
        between[rows, labels] = np.inf
        outside = between.min(1)
        score = (outside - inside) / np.maximum(inside, outside)
    return np.where(own > 1, np.nan_to_num(score), 0.0)


def mean_silhouette(x: np.ndarray, labels: np.ndarray, k: int) -> float:
    unit = unit_rows(x)
    counts, sums = slot_sums(unit, labels, k)
    return float(silhouettes(unit, labels, counts, sums).mean())
