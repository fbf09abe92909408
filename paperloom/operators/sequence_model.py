"""Linear-chain labelling of a page's lines with given weights."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

from paperloom.operators.runs import map_runs


def _logsum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def label_lines(lines: DataFrame, page: list[str], line: str, state_weights: DataFrame, transition_weights: DataFrame) -> DataFrame:
    """page..., line, section, conf: the most probable labels of each page and their marginals.

    ``lines`` has an array ``features`` of name=value strings per line; ``state_weights`` is
    (feature, label, weight), ``transition_weights`` (label_from, label_to, weight). Both come
    from outside; unknown features count nothing. A group is the lines of one page. Without any
    weight there are no labels, and the result is empty.
    """
    state: dict[str, dict[str, float]] = {}
    for r in state_weights.select("feature", "label", "weight").toLocalIterator():
        state.setdefault(r[0], {})[r[1]] = float(r[2])
    step = {(r[0], r[1]): float(r[2]) for r in transition_weights.select("label_from", "label_to", "weight").toLocalIterator()}
    labels = sorted({x for w in state.values() for x in w} | {x for pair in step for x in pair})
    shared = lines.sparkSession.sparkContext.broadcast((state, step, labels))

    def run(key: tuple, rows: list[tuple]) -> list[tuple]:
        weights, between, names = shared.value
        if not names:
            return []
        rows = sorted(rows, key=lambda r: r[0])
        score = [[sum(weights.get(f, {}).get(y, 0.0) for f in (r[1] if r[1] is not None else [])) for y in names] for r in rows]
        k = range(len(names))
        edge = [[between.get((a, b), 0.0) for b in names] for a in names]
        best, back = [score[0]], []
        forward = [score[0]]
        for s in score[1:]:
            ways = [[best[-1][a] + edge[a][b] for a in k] for b in k]
            back.append([max(k, key=lambda a, w=w: w[a]) for w in ways])
            best.append([max(w) + s[b] for b, w in enumerate(ways)])
            forward.append([_logsum([forward[-1][a] + edge[a][b] for a in k]) + s[b] for b in k])
        backward = [[0.0 for _ in k]]
        for s in reversed(score[1:]):
            backward.insert(0, [_logsum([edge[a][b] + s[b] + backward[0][b] for b in k]) for a in k])
        total = _logsum(forward[-1])
        at = max(k, key=lambda y: best[-1][y])
        path = [at]
        for links in reversed(back):
            at = links[at]
            path.insert(0, at)
        return [(*key, r[0], names[y], math.exp(forward[i][y] + backward[i][y] - total)) for i, (r, y) in enumerate(zip(rows, path))]

    kinds = {f.name: f.dataType.simpleString() for f in lines.schema.fields}
    fields = ", ".join(f"{c} {kinds[c]}" for c in [*page, line])
    return map_runs(lines, page, [line, "features"], run, f"{fields}, section string, conf double")
