"""Highlighting: a projection over the (already limited) hits.

A text is cut into fragments by one regular expression, linear in its length,
and each fragment into words and gaps; words that the query looks for get tags.
Nothing is exploded or shuffled.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from fnmatch import fnmatchcase
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import analysis
from ..functions.binding import bound

# Defaults of the highlighter.
DEFAULT_FRAGMENTS = 5
DEFAULT_FRAGMENT_SIZE = 100
DEFAULT_PRE, DEFAULT_POST = "<em>", "</em>"
STYLED_PRE = '<em class="hlt1">'
DEFAULT_BOUNDARY_CHARS = ".,!? \t\n"
DEFAULT_BOUNDARY_MAX_SCAN = 20


@dataclass
class HighlightField:
    field: str
    fragments: int | None = None
    fragment_size: int | None = None
    no_match_size: int | None = None
    query: Any = None
    require_field_match: bool = True
    pre: str | None = None
    post: str | None = None
    tags_schema: str | None = None
    boundary_scanner: str | None = None
    boundary_chars: str | None = None
    boundary_max_scan: int | None = None
    fragmenter: str | None = None
    fragment_offset: int | None = None
    fields: list[str] | None = None
    matched_fields: list[str] | None = None
    order: str | None = None

    @property
    def n_fragments(self) -> int:
        return DEFAULT_FRAGMENTS if self.fragments is None else self.fragments

    @property
    def size(self) -> int:
        return DEFAULT_FRAGMENT_SIZE if self.fragment_size is None else self.fragment_size

    @property
    def tags(self) -> tuple[str, str]:
        default = STYLED_PRE if self.tags_schema == "styled" else DEFAULT_PRE
        return (default if self.pre is None else self.pre, DEFAULT_POST if self.post is None else self.post)


@dataclass
class Highlight:
    fields: list[HighlightField] = field(default_factory=list)

    def add(self, name: str, fragments: int = 3, fragment_size: int = 100, **options) -> HighlightField:
        entry = HighlightField(name, fragments, fragment_size, **options)
        self.fields.append(entry)
        return entry


@dataclass
class TermSet:
    """What to mark in a field: words, prefixes, patterns, near words and phrases."""

    words: set[str] = field(default_factory=set)
    prefixes: set[str] = field(default_factory=set)
    patterns: set[str] = field(default_factory=set)
    near: set[tuple[str, int, bool]] = field(default_factory=set)
    phrases: set[tuple[str, ...]] = field(default_factory=set)

    def update(self, other: "TermSet") -> None:
        for name in self.__dataclass_fields__:
            getattr(self, name).update(getattr(other, name))

    def is_hit(self, parts: Column, part: Column, i: Column) -> Column:
        """Is the piece at index ``i`` a word to mark?"""
        word = F.lower(part)
        tests = []
        if self.words:
            tests.append(word.isin(*sorted(self.words)))
        tests += [F.startswith(word, F.lit(p)) for p in sorted(self.prefixes)]
        tests += [word.rlike(p) for p in sorted(self.patterns)]
        tests += [
            analysis.edit_distance_within(word, t, k, swaps) for t, k, swaps in sorted(self.near)
        ]
        # Words and gaps alternate, so the next word is two pieces on.
        for phrase in sorted(self.phrases):
            for place in range(len(phrase)):
                here = None
                for j, term in enumerate(phrase):
                    step = 2 * (j - place)
                    at = F.lower(F.get(parts, i + F.lit(step))) == F.lit(term)
                    # get() gives NULL for an index outside the array.
                    here = at if here is None else here & at
                tests.append(F.coalesce(here, F.lit(False)))
        result = F.lit(False)
        for test in tests:
            result = result | test
        return part.rlike(f"^{analysis.WORD}$") & result


def collect_terms(query, scope) -> dict[str, TermSet]:
    """Terms of a query by field; ``must_not`` parts mark nothing."""
    from . import queries as q

    found: dict[str, TermSet] = {}

    def into(name: str) -> TermSet:
        return found.setdefault(scope.local_name(name), TermSet())

    def analyzer_of(name: str, given: str | None = None) -> str:
        f = scope.field(name)
        return given or (f.analyzer if f is not None and f.analyzer else "standard")

    def visit(node) -> None:
        if isinstance(node, q.Term):
            into(node.field).words.add(str(node.term).lower())
        elif isinstance(node, q.Terms):
            into(node.field).words.update(str(t).lower() for t in node.terms)
        elif isinstance(node, q.Match):
            for t in analysis.analyze(node.query, analyzer_of(node.field, node.analyzer)):
                if node.fuzziness in (None, 0, "0"):
                    into(node.field).words.add(t.lower())
                else:
                    auto = isinstance(node.fuzziness, str) and node.fuzziness.lower() == "auto"
                    k = analysis.auto_fuzziness(t) if auto else int(node.fuzziness)
                    into(node.field).near.add((t.lower(), k, node.transpositions))
        elif isinstance(node, q.MatchPhrase):
            terms = [t.lower() for t in analysis.analyze(node.phrase, analyzer_of(node.field, node.analyzer))]
            if terms and node.prefix:
                into(node.field).prefixes.add(terms.pop())
            if len(terms) > 1 and node.slop == 0 and not node.prefix:
                into(node.field).phrases.add(tuple(terms))
            else:
                into(node.field).words.update(terms)
        elif isinstance(node, q.MultiMatch):
            for name in node.fields:
                if node.type in ("phrase", "phrase_prefix"):
                    visit(q.MatchPhrase(name, node.query, prefix=node.type == "phrase_prefix"))
                else:
                    visit(q.Match(name, node.query, node.operator))
        elif isinstance(node, q.Wildcard):
            into(node.field).patterns.add(analysis.wildcard_regex(node.pattern.lower()))
        elif isinstance(node, q.Bool):
            for clause in node.clauses:
                if clause.occur != "must_not":
                    for part in clause.queries:
                        visit(part)
        elif isinstance(node, q.DisMax):
            for part in node.queries:
                visit(part)
        elif isinstance(node, (q.ConstantScore, q.FunctionScore)):
            visit(node.query)

    visit(query)
    return found


def highlight_terms(query, scope, field_name: str, hl: HighlightField) -> TermSet:
    """Terms to mark in ``field_name`` under the options of ``hl``."""
    by_field = collect_terms(query, scope)
    wanted = hl.matched_fields if hl.matched_fields is not None else hl.fields
    names = [field_name]
    if not hl.require_field_match:
        names = list(by_field)
    elif wanted is not None:
        names = [n for n in by_field if any(fnmatchcase(n, p) for p in wanted)]
    result = TermSet()
    for name in names:
        if name in by_field:
            result.update(by_field[name])
    return result


def _fragment_regex(hl: HighlightField, terms: TermSet) -> str:
    """One fragment: ``size`` characters, then on to the next boundary."""
    unit = r"[\s\S]"
    if hl.fragmenter == "span" and terms.phrases:
        whole = "|".join(
            analysis.NON_WORD.join(re.escape(t) for t in phrase) for phrase in sorted(terms.phrases)
        )
        # A phrase counts as one unit, so a cut never falls inside it.
        bound = analysis.WORD_CHARS
        unit = rf"(?:(?<![{bound}])(?iu:{whole})(?![{bound}])|[\s\S])"
    elif hl.fragmenter not in (None, "simple", "span"):
        raise ValueError(f"unknown fragmenter {hl.fragmenter!r}")
    if hl.size < 1:
        raise ValueError("the fragment size must be positive")
    body = unit + "{1," + str(hl.size) + "}"
    if hl.boundary_scanner in (None, "word"):
        return body + f"[{analysis.WORD_CHARS}]*"
    if hl.boundary_scanner == "sentence":
        return body + r"[^.!?]*[.!?]*\s*"
    if hl.boundary_scanner == "chars":
        chars = DEFAULT_BOUNDARY_CHARS if hl.boundary_chars is None else hl.boundary_chars
        scan = DEFAULT_BOUNDARY_MAX_SCAN if hl.boundary_max_scan is None else hl.boundary_max_scan
        stops = "".join(re.escape(c) for c in chars)
        return body + (f"[^{stops}]" if stops else unit) + "{0," + str(scan) + "}"
    raise ValueError(f"unknown boundary scanner {hl.boundary_scanner!r}")


def highlight_column(text: Column, terms: TermSet, hl: HighlightField) -> Column:
    """Highlighted fragments of a string column, ``array<string>``."""
    pre, post = hl.tags
    source = text if not hl.fragment_offset else F.substring(text, hl.fragment_offset + 1, 2**31 - 1)
    if hl.n_fragments == 0:
        cut = F.array(source)
    else:
        cut = F.regexp_extract_all(source, F.lit(_fragment_regex(hl, terms)), 0)

    def mark(fragment: Column) -> Column:
        return bound(analysis.pieces(fragment), lambda parts: mark_parts(fragment, parts))

    def mark_parts(fragment: Column, parts: Column) -> Column:
        marked = F.transform(
            parts,
            lambda x, i: F.when(terms.is_hit(parts, x, i), F.concat(F.lit(pre), x, F.lit(post))).otherwise(x),
        )
        joined = F.array_join(marked, "")
        if pre or post:
            # The gain in length tells how many words were marked.
            hits = F.length(joined) - F.length(fragment)
        else:
            hits = F.size(F.filter(parts, lambda x, i: terms.is_hit(parts, x, i)))
        return F.struct(hits.alias("hits"), joined.alias("text"))

    marked = F.filter(F.transform(cut, mark), lambda m: m["hits"] > 0)
    if hl.order == "score":
        marked = F.sort_array(
            F.transform(
                marked, lambda m, i: F.struct((-m["hits"]).alias("rank"), i.alias("place"), m["text"].alias("text"))
            )
        )
    elif hl.order is not None and hl.order != "none":
        raise ValueError(f"unknown highlight order {hl.order!r}")
    fragments = F.transform(marked, lambda m: m["text"])
    if hl.n_fragments > 0:
        fragments = F.slice(fragments, 1, hl.n_fragments)
    if hl.no_match_size:
        opening = F.array(F.substring(text, 1, hl.no_match_size))
        fragments = F.when(F.size(fragments) == 0, opening).otherwise(fragments)
    return F.coalesce(fragments, F.expr("array()").cast("array<string>"))


def highlights(query, scope, spec: Highlight) -> Column:
    """``map<field, fragments>``; fields without a fragment are left out."""
    entries = []
    for hl in spec.fields:
        f = scope.field(hl.field)
        if f is None:
            continue
        terms = highlight_terms(hl.query if hl.query is not None else query, scope, f.name, hl)
        if f.is_array:
            column = F.flatten(F.transform(f.column, lambda v: highlight_column(v, terms, hl)))
            if hl.n_fragments > 0:
                column = F.slice(column, 1, hl.n_fragments)
        else:
            column = highlight_column(f.column, terms, hl)
        entries += [F.lit(f.name), column]
    if not entries:
        return F.expr("map()").cast("map<string,array<string>>")
    return F.map_filter(F.create_map(*entries), lambda _, fragments: F.size(fragments) > 0)
