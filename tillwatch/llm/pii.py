"""Personal data by patterns and a skip-chain conditional random field.

Patterns give the base spans. Around them, number chains and address-like words are the nodes of a
random field with one label per kind and "none". A node's own potential is a linear softmax over its
shape, fitted in numpy to weak labels (what the patterns say about the nodes of a bounded sample).
Neighbours in the text share a chain potential; nodes with the same digits, address or mailbox name, or the
last digits of a phone number, share a skip potential with one hub node, however far apart and many they are. The hub
is held to what the patterns said about any of them. Loopy sum-product messages
over a document's nodes then settle the labels, so a number once seen as a phone number is one wherever
it comes back in another form. Documents are independent: a task labels them one by one.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.llm.common import free_name, ship, struct_of

# Kinds in their order, base patterns and limits.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)
#: As many last digits make a phone number the same with and without its country.
TAIL_DIGITS = 9

NONE = len(KINDS)
_NUMBER = re.compile(r"\+?\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,}")
_NAME = re.compile(r"[A-Za-z0-9._%+-]{5,}")
_DOUBLE = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(_DOUBLE[int(d)] for d in even)) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from their @ signs (a long run of letters costs nothing)."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and _is_local(text[begin - 1]):
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            found.append((begin, domain.end()))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    return found


def _is_local(c: str) -> bool:
    return c < "\x80" and (c.isalnum() or c in "._%+-")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of what the base patterns accept, in code points."""
    found = [(0, a, b) for a, b in emails(text)]
    for m in IP.finditer(text) if "." in text else ():
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS[0]:
            digits = digits_of(m[0])
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                found.append((2, m.start(), m.end()))
    for m in PHONE.finditer(text) if "+" in text else ():
        if PHONE_DIGITS[0] <= len(digits_of(m[0])) <= PHONE_DIGITS[1]:
            found.append((3, m.start(), m.end()))
    return found


@dataclass
class Node:
    start: int
    end: int
    key: str
    seen: int  # the kind of the base span that covers the node, or NONE


def nodes_of(text: str, base: list[tuple[int, int, int]]) -> list[Node]:
    """Number chains, addresses and, where addresses occur, the words that equal their mailbox names."""
    cover = sorted((a, b, k) for k, a, b in base)
    found = [Node(a, b, text[a:b].lower(), 0) for k, a, b in base if k == 0]
    names = {text[a:b].split("@")[0].lower() for k, a, b in base if k == 0}
    names = {n for n in names if any(c in "._+-0123456789" for c in n.strip("._+-"))}
    if names:
        found += [Node(m.start(), m.end(), m[0].lower(), NONE) for m in _NAME.finditer(text)
                  if m[0].lower() in names and text[m.end():m.end() + 1] != "@"]
    at = 0
    for m in _NUMBER.finditer(text):
        while at < len(cover) and cover[at][1] <= m.start():
            at += 1
        kind, k = NONE, at
        while k < len(cover) and cover[k][0] < m.end():
            if cover[k][2] and cover[k][1] > m.start():
                kind = cover[k][2]
                break
            k += 1
        found.append(Node(m.start(), m.end(), digits_of(m[0]), kind))
    return sorted(found, key=lambda n: (n.start, n.end))


def shape(text: str, node: Node) -> list[float]:
    own = text[node.start:node.end]
    n = len(digits_of(own))
    return [1.0, float("@" in own), float(n == 0), float(7 <= n <= 9), float(10 <= n <= 13), float(14 <= n <= 16),
            float(n > 16), own.count(".") / 4, (own.count("-") + own.count(" ")) / 4, float("(" in own),
            float(own.startswith("+")), float(n >= 12 and luhn(digits_of(own)))]


@dataclass
class Field:
    """weights: (features, labels). chain: log-potential of neighbours' labels. skip: bonus for equal labels."""

    weights: np.ndarray
    chain: np.ndarray
    skip: float = 2.5
    trust: float = 6.0


def fit(texts: list[str], steps: int = 200, rate: float = 0.5) -> Field:
    """Own and chain potentials from the nodes of ``texts`` under their base labels (no nodes: flat)."""
    rows, labels, pairs = [], [], np.ones((NONE + 1, NONE + 1))
    for text in texts:
        if isinstance(text, str):
            nodes = nodes_of(text, base_spans(text))
            rows += [shape(text, n) for n in nodes]
            labels += [n.seen for n in nodes]
            for a, b in zip(nodes, nodes[1:], strict=False):
                pairs[a.seen, b.seen] += 1
    weights = np.zeros((12, NONE + 1))
    if rows:
        x, y = np.array(rows), np.eye(NONE + 1)[labels]
        for _ in range(steps):
            p = np.exp(x @ weights - (x @ weights).max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            weights -= rate * (x.T @ (p - y) / len(x) + 1e-3 * weights)
    own = pairs.sum(axis=1, keepdims=True) @ pairs.sum(axis=0, keepdims=True) / pairs.sum()
    return Field(weights, np.clip(np.log(pairs / own), -1, 1))


def groups_of(nodes: list[Node]) -> list[list[int]]:
    """The nodes that repeat each other, by key.

    Mailbox names share the key of their addresses. A number of a phone's length shares its last digits with a
    phone number, whatever stands for its country; it is then in that group alone.
    """
    def tail(node: Node) -> str:
        return "*" + node.key[-TAIL_DIGITS:] if node.key.isdigit() and TAIL_DIGITS <= len(node.key) <= PHONE_DIGITS[1] else ""

    phones = {tail(n) for n in nodes if n.seen == KINDS.index("phone")} - {""}
    groups: dict[str, list[int]] = {}
    for i, node in enumerate(nodes):
        if "@" in node.key:
            keys = {node.key, node.key.split("@")[0]}
        else:
            keys = {tail(node) if tail(node) in phones and node.seen in (NONE, KINDS.index("phone")) else node.key}
        for key in keys:
            groups.setdefault(key, []).append(i)
    return [g for g in groups.values() if len(g) > 1]


def edges_of(nodes: list[Node], groups: list[list[int]]) -> tuple[np.ndarray, int]:
    """Chain edges between neighbours, then skip edges between the hub of each group and its nodes.

    Hubs are numbered after the nodes, so n occurrences cost n edges and any two are two edges apart.
    """
    chain = [(i, i + 1) for i in range(len(nodes) - 1)]
    skip = [(len(nodes) + h, i) for h, group in enumerate(groups) for i in group]
    return np.array(chain + skip, dtype=np.int64).reshape(-1, 2), len(chain)


def marginals(own: np.ndarray, edges: np.ndarray, chains: int, field: Field, rounds: int = 200) -> np.ndarray:
    """Loopy sum-product over log-potentials, damped, until messages rest; one row of label probabilities per node."""
    potential = np.empty((len(edges), NONE + 1, NONE + 1))
    potential[:chains] = np.exp(field.chain)
    potential[chains:] = np.exp(field.skip * np.eye(NONE + 1))
    forward, backward = np.zeros((len(edges), NONE + 1)), np.zeros((len(edges), NONE + 1))
    belief = own.copy()
    for _ in range(rounds if len(edges) else 0):
        before = belief
        for into, out, side in ((forward, backward, 0), (backward, forward, 1)):
            cavity = belief[edges[:, side]] - out
            cavity = np.exp(cavity - cavity.max(axis=1, keepdims=True))
            sent = np.einsum("ea,eab->eb" if side == 0 else "eb,eab->ea", cavity, potential)
            sent = np.log(sent / sent.sum(axis=1, keepdims=True) + 1e-12)
            into[:] = 0.5 * into + 0.5 * sent
        belief = own.copy()
        np.add.at(belief, edges[:, 1], forward)
        np.add.at(belief, edges[:, 0], backward)
        if np.abs(belief - before).max() < 1e-4:
            break
    belief = np.exp(belief - belief.max(axis=1, keepdims=True))
    return belief / belief.sum(axis=1, keepdims=True)


def spans(text: str | None, field: Field, least: float = 0.5) -> tuple[list, list]:
    """Base spans, and what the field adds: labelled nodes that no base span overlaps."""
    if not isinstance(text, str) or not text:
        return [], []
    base = base_spans(text)
    nodes = nodes_of(text, base)
    if not nodes:
        return base, []
    own = np.array([shape(text, n) for n in nodes]) @ field.weights
    for i, node in enumerate(nodes):
        if node.seen != NONE:
            own[i, node.seen] += field.trust
        else:  # the patterns saw the node and took it for nothing: only its repetitions speak for it
            own[i, NONE] += 1.0
    groups = groups_of(nodes)
    hubs = np.zeros((len(groups), NONE + 1))
    for hub, group in zip(hubs, groups, strict=True):
        for i in group:  # outweighs all that the other occurrences say, however many they are
            if nodes[i].seen != NONE:
                hub[nodes[i].seen] += field.trust * len(group)
    p = marginals(np.concatenate([own, hubs]), *edges_of(nodes, groups), field)[:len(nodes)]
    bounds, added = sorted((a, b) for _, a, b in base), []
    ends = np.maximum.accumulate([b for _, b in bounds]) if bounds else np.zeros(0)
    starts = [a for a, _ in bounds]
    for node, row in zip(nodes, p, strict=True):
        label = int(row.argmax())
        if node.seen == NONE and label != NONE and row[label] >= least:
            before = int(np.searchsorted(starts, node.end)) - 1
            if before < 0 or ends[before] <= node.start:
                added.append((label, node.start, node.end))
    return base, added


def train(docs: DataFrame, most: int = 2000, text: str = "text", key: str = "doc_id") -> Field:
    """The field fitted to at most about ``most`` documents that hold an @ sign or a long number.

    Which ones is decided by a hash of id and text and by how many there are, row by row, so no row moves that is
    not taken; equal rows are taken once. The sample meets in one task, and only the field reaches the driver.
    """
    scale = 1 << 30
    likely = docs.where(F.col(text).contains("@") | F.col(text).rlike(r"[0-9][0-9 .()-]{8,}[0-9]"))
    n = likely.count()
    share = scale if n <= most else int(scale * most / n)
    hashed = likely.select(F.col(text).alias("text"), F.xxhash64(key, text).alias("hash")).where(F.pmod("hash", F.lit(scale)) < share)
    sample = hashed.groupBy("hash").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True).sort_values("hash")
        yield pd.DataFrame({"field": [pickle.dumps(fit(rows["text"].tolist()))]})

    ship(docs.sparkSession)
    found = sample.repartition(1).mapInPandas(run, "field binary").collect()
    return pickle.loads(found[0]["field"]) if found else fit([])


def find(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``base`` and ``added``: arrays of (kind number, start, stop).

    Null and empty texts have empty arrays; taken names get underscores in front; rows are not shuffled.
    """
    one = T.ArrayType(struct_of(("kind", T.IntegerType()), ("start", T.LongType()), ("stop", T.LongType())))
    base_name = free_name(docs.columns, "base")
    added_name = free_name(docs.columns, "added")
    schema = struct_of(*((f.name, f.dataType) for f in docs.schema.fields), (base_name, one), (added_name, one))
    model = docs.sparkSession.sparkContext.broadcast(field)

    def rows(found: list[tuple[int, int, int]]) -> list[dict]:
        return [{"kind": k, "start": a, "stop": b} for k, a, b in found]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            both = [spans(v, model.value) for v in batch[text]]
            yield batch.assign(**{base_name: [rows(b) for b, _ in both], added_name: [rows(a) for _, a in both]})

    ship(docs.sparkSession)
    return docs.mapInPandas(run, schema)
