"""A hierarchical navigable small-world graph over unit vectors, many queries at a time.

Level 0 links all vectors, every higher level the first 1 in ``LEVEL_RATIO`` of the one
below; vectors are stored in random order, so that is a random choice. A query
walks down greedily and keeps a beam of the best vectors on level 0.
"""

import numpy as np

LEVEL_RATIO = 16
#: Links of a vector, on level 0 and on the others.
LINKS, UPPER_LINKS = 24, 12
BUILD_BEAM = 48
BUILD_BATCH = 512
#: Vectors of a beam whose links are followed together.
STEPS = 16
NONE = -1


def _best(ids: np.ndarray, sims: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``size`` most similar entries of each row, best first."""
    order = np.argsort(-sims, axis=1, kind="stable")[:, :size]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


class Graph:
    def __init__(self, vectors: np.ndarray, links: list[np.ndarray] | None = None):
        """Over unit vectors in random order; with ``links`` of a stored graph nothing is built."""
        self.vectors = vectors
        if links is not None:
            self.links = links
            return
        sizes = [len(vectors)]
        while sizes[-1] > LEVEL_RATIO:
            sizes.append(-(-sizes[-1] // LEVEL_RATIO))
        self.links = [
            np.full((n, UPPER_LINKS if level else LINKS), NONE, np.int32)
            for level, n in enumerate(sizes)
        ]
        done = 0
        while done < len(vectors):
            step = min(max(2 * done, LEVEL_RATIO) - done, BUILD_BATCH, len(vectors) - done)
            self._insert(done, done + step)
            done += step

    # --- building ---

    def _insert(self, first: int, last: int) -> None:
        entry = np.zeros((last - first, 1), np.int32)
        for level in range(len(self.links) - 1, -1, -1):
            end = min(last, len(self.links[level]))
            if end <= first:
                if first:
                    entry = self._search(level, self.vectors[first:last], entry, 1, self._size(level, first))[0]
                continue
            new = np.arange(first, end)
            queries = self.vectors[first:end]
            among = queries @ queries.T
            np.fill_diagonal(among, -np.inf)
            ids = np.broadcast_to(new.astype(np.int32), among.shape)
            width = min(BUILD_BEAM, among.shape[1])
            ids, sims = _best(ids, among, width)
            if first:
                found, near = self._search(level, queries, entry[: len(new)], BUILD_BEAM, first)
                ids, sims = _best(
                    np.concatenate([found, ids], 1), np.concatenate([near, sims], 1), BUILD_BEAM
                )
                rest = entry[len(new) :]
                if len(rest):
                    rest = self._search(level, self.vectors[end:last], rest, 1, first)[0]
                entry = np.concatenate([found[:, :1], rest])
            chosen = self._diverse(ids, sims, self.links[level].shape[1])
            self.links[level][first:end] = chosen
            self._link_back(level, new, chosen)

    def _size(self, level: int, first: int) -> int:
        return min(first, len(self.links[level]))

    def _diverse(self, ids: np.ndarray, sims: np.ndarray, size: int) -> np.ndarray:
        """Of each row's candidates, best first, those nearer to it than to any chosen before.

        Places left over go to the best of the others.
        """
        rows, width = ids.shape
        ids = np.where(np.isfinite(sims), ids, NONE)
        near = np.zeros(ids.shape, bool)
        count = np.zeros(rows, np.int64)
        chosen = np.full((rows, size), NONE, np.int32)
        for k in range(width):
            here = np.flatnonzero((ids[:, k] != NONE) & (count < size))
            if not len(here):
                continue
            filled = int(count[here].max())
            ok = np.ones(len(here), bool)
            if filled:
                others = chosen[here, :filled]
                mutual = np.einsum(
                    "rsd,rd->rs", self.vectors[others], self.vectors[ids[here, k]], optimize=False
                )
                ok = (np.where(others == NONE, -np.inf, mutual) < sims[here, k : k + 1]).all(axis=1)
            near[here[~ok], k] = True
            good = here[ok]
            chosen[good, count[good]] = ids[good, k]
            count[good] += 1
        for k in range(width):
            more = np.flatnonzero(near[:, k] & (count < size))
            chosen[more, count[more]] = ids[more, k]
            count[more] += 1
        return chosen

    def _link_back(self, level: int, new: np.ndarray, chosen: np.ndarray) -> None:
        links = self.links[level]
        sources = np.repeat(new, chosen.shape[1])
        targets = chosen.ravel()
        real = targets != NONE
        sources, targets = sources[real], targets[real]
        known = (links[targets] == sources[:, None]).any(axis=1)
        sources, targets = sources[~known], targets[~known]
        order = np.argsort(targets, kind="stable")
        sources, targets = sources[order], targets[order]
        nodes, starts, counts = np.unique(targets, return_index=True, return_counts=True)
        if not len(nodes):
            return
        place = np.arange(len(targets)) - np.repeat(starts, counts)
        added = np.full((len(nodes), int(counts.max())), NONE, np.int32)
        added[np.repeat(np.arange(len(nodes)), counts), place] = sources
        every = np.concatenate([links[nodes], added], axis=1)
        full = (every != NONE).sum(axis=1) > links.shape[1]
        packed = np.take_along_axis(every, np.argsort(every == NONE, axis=1, kind="stable"), 1)
        links[nodes[~full]] = packed[~full, : links.shape[1]]
        if full.any():
            ids = every[full]
            sims = np.einsum("rsd,rd->rs", self.vectors[ids], self.vectors[nodes[full]])
            sims[ids == NONE] = -np.inf
            ids, sims = _best(ids, sims, ids.shape[1])
            links[nodes[full]] = self._diverse(ids, sims, links.shape[1])

    # --- searching ---

    def _search(
        self, level: int, queries: np.ndarray, entry: np.ndarray, beam: int, size: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """The beam of each query among the first ``size`` vectors of a level, best first."""
        links, rows = self.links[level], len(queries)
        beam = min(beam, size)
        ids = np.full((rows, beam), NONE, np.int32)
        sims = np.full((rows, beam), -np.inf, np.float32)
        width = min(entry.shape[1], beam)
        entry = entry[:, :width]
        # The column that met a vector; of several at once the last one counts.
        met = np.full((rows, size), NONE, np.int16)
        real = entry != NONE
        ids[:, :width] = entry
        start = np.einsum("rsd,rd->rs", self.vectors[entry], queries)
        sims[:, :width] = np.where(real, start, -np.inf)
        met[np.nonzero(real)[0], entry[real]] = 0
        done = ~np.isfinite(sims)
        steps = min(STEPS, beam)
        while True:
            waiting = np.where(done, -np.inf, sims)
            at = np.argpartition(-waiting, steps - 1, axis=1)[:, :steps] if steps > 1 else waiting.argmax(axis=1)[:, None]
            open_at = np.isfinite(np.take_along_axis(waiting, at, 1))
            live = np.flatnonzero(open_at.any(axis=1))
            if not len(live):
                return _best(ids, sims, beam)
            at, open_at = at[live], open_at[live]
            done[live[:, None], at] = True
            near = np.where(open_at[:, :, None], links[ids[live[:, None], at]], NONE).reshape(len(live), -1)
            row, column = np.nonzero((near != NONE) & (near < size))
            node = near[row, column]
            new = met[live[row], node] == NONE
            row, column, node = row[new], column[new], node[new]
            met[live[row], node] = column
            first = met[live[row], node] == column
            row, column, node = row[first], column[first], node[first]
            values = np.full(near.shape, -np.inf, np.float32)
            values[row, column] = np.einsum("nd,nd->n", self.vectors[node], queries[live[row]])
            all_sims = np.concatenate([sims[live], values], axis=1)
            top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            sims[live] = np.take_along_axis(all_sims, top, 1)
            ids[live] = np.take_along_axis(np.concatenate([ids[live], near], axis=1), top, 1)
            fresh_done = np.concatenate([done[live], ~np.isfinite(values)], axis=1)
            done[live] = np.take_along_axis(fresh_done, top, 1)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and similarities of the best ``beam`` vectors that each query's walk meets."""
        entry = np.zeros((len(queries), 1), np.int32)
        for level in range(len(self.links) - 1, 0, -1):
            entry = self._search(level, queries, entry, 4, len(self.links[level]))[0]
        return self._search(0, queries, entry, beam, len(self.links[0]))
