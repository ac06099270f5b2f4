"""Order-dependent clustering of token sequences by prefix tree and Jaccard similarity, one state a tenant."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktel.operators.logtokens import fingerprint

THRESHOLD = 0.5


def similarity(a: frozenset[str] | set[str], b: frozenset[str] | set[str]) -> float:
    union = len(a | b)
    return len(a & b) / union if union else 0.0


@dataclass
class Cluster:
    fingerprint: int
    words: set[str]
    matched: int = 1
    seen: int = 1

    def see(self, words: set[str], hit: bool) -> None:
        """Count an attempt; a hit narrows the words to the shared ones."""
        self.seen += 1
        if hit:
            self.matched += 1
            self.words &= words

    @property
    def rate(self) -> float:
        return self.matched / self.seen if self.seen else 0.0


@dataclass
class Node:
    """A place in the tree; children and clusters keep their order of arrival, so results depend on the input alone."""

    children: dict[str, Node] = field(default_factory=dict)
    clusters: list[Cluster] = field(default_factory=list)

    def under(self) -> Iterator[Node]:
        todo = [self]
        while todo:
            node = todo.pop()
            if node.clusters:
                yield node
            todo += reversed(node.children.values())


class Clusterer:
    """cluster(tokens, keys) gives the fingerprint of the cluster that the message joins or begins."""

    def __init__(self, threshold: float = THRESHOLD):
        self.threshold, self.root = threshold, Node()

    def cluster(self, tokens: list[str], keys: list[str]) -> int:
        if not tokens:  # nothing is ever similar to no words: no state is needed
            return fingerprint(tokens, keys)
        node, rest = self.root, list(tokens)
        while rest and rest[0] in node.children:
            node = node.children[rest.pop(0)]
        words = set(tokens)
        if rest:
            found = self._best(node, words)
            if found is not None:
                return found
            for t in rest:
                node = node.children.setdefault(t, Node())
        return self._at(node, words, tokens, keys)

    def _best(self, node: Node, words: set[str]) -> int | None:
        scored = [(similarity(c.words, words), c.fingerprint, leaf) for leaf in node.under() for c in leaf.clusters]
        good = [s for s in scored if s[0] >= self.threshold]
        if not good:
            return None
        _, mark, leaf = max(good, key=lambda s: s[0])  # the first of equals
        next(c for c in leaf.clusters if c.fingerprint == mark).see(words, True)
        return mark

    def _at(self, node: Node, words: set[str], tokens: list[str], keys: list[str]) -> int:
        hits = [similarity(c.words, words) >= self.threshold for c in node.clusters]
        for c, hit in zip(node.clusters, hits, strict=True):
            c.see(words, hit)
        if True not in hits:
            node.clusters.insert(0, Cluster(fingerprint(tokens, keys), words))
            return node.clusters[0].fingerprint
        at = hits.index(True)
        best, row = node.clusters[at], node.clusters
        while at and best.rate > row[at - 1].rate:
            row[at - 1], row[at] = row[at], row[at - 1]
            at -= 1
        return best.fingerprint


def with_clusters(df: DataFrame, tenant: str, order: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """df (log_tokens, log_json_keys) with log_cluster; 0 for a null token list.

    Sequential by nature: each message changes the state that the next one meets, so a tenant's messages go through one
    task in order.  Only their tokens, keys and `order` do; the other columns stay where they are and are joined by
    tenant and order in parallel, so the two must tell a tenant's rows apart (rows that share them share a cluster).
    Use log_fingerprint where independent tasks matter more than clusters.
    """
    names = [tenant, *order]
    rows = df.select(*names, "log_tokens", "log_json_keys").repartition(F.col(tenant)).sortWithinPartitions(*names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, state, before, mark = object(), Clusterer(threshold), None, 0
        for pdf in batches:
            out, new = [], []
            for *place, t, k in pdf.itertuples(index=False, name=None):
                if place[0] != held:
                    held, state, before = place[0], Clusterer(threshold), None
                new.append(place != before)
                if new[-1]:
                    before, mark = place, 0 if t is None else state.cluster(list(t), [] if k is None else list(k))
                out.append(mark)
            yield pdf[names].assign(log_cluster=out)[pd.Series(new, index=pdf.index, dtype=bool)]

    schema = ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)
    found = rows.mapInPandas(run, f"{schema}, log_cluster bigint").select(*[F.col(n).alias(f"_{i}") for i, n in enumerate(names)], "log_cluster")
    same = reduce(and_, [F.col(n).eqNullSafe(F.col(f"_{i}")) for i, n in enumerate(names)])
    return df.join(found, same).select(*df.columns, "log_cluster")


class Tenants:
    """A clusterer for each tenant, as a service keeps them: made on first use, until removed."""

    def __init__(self, threshold: float = THRESHOLD):
        self.threshold, self.held = threshold, {}

    def cluster(self, tenant: str, tokens: list[str], keys: list[str]) -> int:
        if tenant not in self.held:
            self.held[tenant] = Clusterer(self.threshold)
        return self.held[tenant].cluster(tokens, keys)

    def remove(self, tenant: str) -> bool:
        return self.held.pop(tenant, None) is not None

    def ids(self) -> list[str]:
        return list(self.held)

    def __len__(self) -> int:
        return len(self.held)
