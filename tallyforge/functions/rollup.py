"""Mergeable rollup state.

A rollup's state has one row per group of its grain keys:

* the additive sums and the maxima;
* for each tracked number (a latency) ``<name>_counts``, the sorted (value, n) pairs of how often each
  value was seen: a lossless histogram of an integer column;
* for each tracked identifier ``<name>_set``, the sorted distinct members.

Reports that need no percentiles don't read the arrays.  Percentiles of merged rows are
read off the sorted pairs row by row, without a shuffle.

Building and merging never collect raw rows.  Requests, or the pairs of stored arrays, become rows of (keys, facet, value,
member, n) that are first grouped with map-side combine, so a hot key sends one row per distinct value and map task, spread
over tasks by value; only then are the distinct values of a group put in its array.  Batches may arrive
in any number and order, and a coarser grain is the same grouping over fewer keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.measures import quantile_label

TOTAL = "total"


def expressions(*texts: str) -> list[Column]:
    return [F.expr(text) for text in texts]


def _points(quantiles: Sequence[float]) -> str:
    return f"array({', '.join(f'{float(q)}D' for q in quantiles)})"


def _point(name: str, q: float) -> str:
    """The quantile ``q`` of the sorted pairs ``<name>_counts``, where ``_last_<name>`` is the place of the last value."""
    place = f"(_last_{name} * {float(q)}D)"
    reach = lambda at, key: f"'{key}', coalesce(a.{key}, if(a.seen + e.n > {at}({place}), e.value, NULL))"
    step = f"named_struct('seen', a.seen + e.n, {reach('floor', 'low')}, {reach('ceil', 'high')})"
    none = "CAST(NULL AS BIGINT)"
    between = f"a.low * (1 + floor({place}) - {place}) + a.high * ({place} - floor({place}))"
    return (
        f"aggregate({name}_counts, named_struct('seen', 0L, 'low', {none}, 'high', {none}), (a, e) -> {step},"
        f" a -> if(a.low = a.high, CAST(a.low AS DOUBLE), {between}))"
    )


def quantile_columns(quantiles: Mapping[str, Sequence[float]]) -> list[str]:
    """Expressions for ``<value>_p<q>`` from the percentile arrays ``_q_<value>``."""
    return [
        f"_q_{name}[{i}] AS {name}_{quantile_label(q)}" for name, qs in quantiles.items() for i, q in enumerate(qs)
    ]


@dataclass(frozen=True)
class Rollup:
    """A rollup described by SQL expressions over the request log."""

    name: str
    keys: Mapping[str, str]
    sums: Mapping[str, str]
    maxes: Mapping[str, str] = field(default_factory=dict)
    values: Mapping[str, str] = field(default_factory=dict)
    members: Mapping[str, str] = field(default_factory=dict)
    quantiles: Mapping[str, Sequence[float]] = field(default_factory=dict)
    """Quantiles reported of each value unless a report asks for others."""
    day: str = "event_date"
    """Expression for the calendar day of a row of state, over the keys."""

    def facets(self) -> list[str]:
        return [*self.values, *self.members]

    def _column(self, facet: str) -> str:
        return f"{facet}_counts" if facet in self.values else f"{facet}_set"

    def _held(self, state: DataFrame, wanted: Sequence[str] | None = None) -> list[str]:
        """The wanted facets (all by default) that a state has columns of."""
        return [f for f in self.facets() if self._column(f) in state.columns and (wanted is None or f in wanted)]

    def measures(self) -> list[Column]:
        """The sums and maxima, added up."""
        return expressions(*[f"sum({k}) AS {k}" for k in self.sums], *[f"max({k}) AS {k}" for k in self.maxes])

    def state(self, requests: DataFrame, facets: Sequence[str] | None = None) -> DataFrame:
        """One row per group of a request log.

        ``facets`` names the numbers and identifiers wanted, all by default; without any of
        them this is one plain aggregation.
        """
        wanted = [f for f in self.facets() if facets is None or f in facets]
        rows = self._rows(self._inputs(requests, wanted), wanted or [TOTAL], measured=(wanted or [TOTAL])[0])
        if not wanted:
            return rows.groupBy(*self.keys).agg(*self.measures())
        return self._fold(self._combine(rows, list(self.keys)), wanted)

    def compute(
        self,
        requests: DataFrame,
        quantiles: Mapping[str, Sequence[float]] | None = None,
        members: Sequence[str] | None = None,
    ) -> DataFrame:
        """Readable metrics straight from a log, when no state is to be kept.

        Without distinct members this is one grouped aggregation: Spark's
        percentile buffer counts values on the map side, so a hot group sends
        one bounded buffer per map task.  With members, distinct counting and
        percentiles go through partial rows, where the sums ride on the rows
        of the first facet.
        """
        _, quantiles, members = self._wanted(None, quantiles, members)
        facets = [*quantiles, *members] or [TOTAL]
        inputs = self._inputs(requests, facets)
        if members:
            rows = self._rows(inputs, facets, measured=facets[0])
            return self._finish_rows(self._combine(rows, list(self.keys)), list(self.keys), quantiles, members)
        done = inputs.groupBy(*self.keys).agg(
            *expressions(
                *[f"sum(_s_{k}) AS {k}" for k in self.sums],
                *[f"max(_m_{k}) AS {k}" for k in self.maxes],
                *[f"percentile(_v_{v}, {_points(qs)}) AS _q_{v}" for v, qs in quantiles.items()],
            )
        )
        return done.selectExpr(*self.keys, *self.sums, *self.maxes, *quantile_columns(quantiles))

    def unfolded(self, requests: DataFrame, *carry: str) -> DataFrame:
        """A log's rows by facet as they are counted, with the columns ``carry``; the sums ride on those of the first facet."""
        facets = self.facets() or [TOTAL]
        return self._rows(self._inputs(requests, facets, carry), facets, facets[0], carry)

    def _inputs(self, requests: DataFrame, facets: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
        return requests.selectExpr(
            *carry,
            *[f"{e} AS {k}" for k, e in self.keys.items()],
            *[f"CAST({e} AS BIGINT) AS _s_{k}" for k, e in self.sums.items()],
            *[f"CAST({e} AS BIGINT) AS _m_{k}" for k, e in self.maxes.items()],
            *[f"CAST({e} AS BIGINT) AS _v_{k}" for k, e in self.values.items() if k in facets],
            *[f"CAST({e} AS STRING) AS _i_{k}" for k, e in self.members.items() if k in facets],
        )

    def _rows(self, inputs: DataFrame, facets: Sequence[str], measured: str, carry: Sequence[str] = ()) -> DataFrame:
        """One row per request and facet; the facet ``measured`` carries the sums."""
        no_number, no_text = "CAST(NULL AS BIGINT)", "CAST(NULL AS STRING)"

        def row(facet: str) -> dict[str, str]:
            carries = facet == measured
            return {
                "facet": f"'{facet}'",
                "value": f"_v_{facet}" if facet in self.values else no_number,
                "member": f"_i_{facet}" if facet in self.members else no_text,
                "n": "1L",
                **{k: f"_s_{k}" if carries else no_number for k in self.sums},
                **{k: f"_m_{k}" if carries else no_number for k in self.maxes},
            }

        if len(facets) == 1:
            return inputs.selectExpr(*carry, *self.keys, *[f"{e} AS {k}" for k, e in row(facets[0]).items()])
        structs = [", ".join(f"'{k}', {e}" for k, e in row(facet).items()) for facet in facets]
        return inputs.selectExpr(*carry, *self.keys, f"inline(array({', '.join(f'named_struct({x})' for x in structs)}))")

    def _combine(self, rows: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
        """Each value and member once per ``keys``."""
        return rows.groupBy(*keys, "facet", "value", "member").agg(F.sum("n").alias("n"), *self.measures())

    def _fold(self, combined: DataFrame, facets: Sequence[str]) -> DataFrame:
        """Combined rows as one row per group with sorted arrays, as long as there are distinct values and members."""
        measures = ["facet", "value", "member", "n", *self.sums, *self.maxes]
        keys = [c for c in combined.columns if c not in measures]

        def entry(facet: str) -> str:
            if facet in self.members:
                return f"CASE WHEN facet = '{facet}' THEN member END"
            return f"CASE WHEN facet = '{facet}' AND value IS NOT NULL THEN named_struct('value', value, 'n', n) END"

        arrays = [f"sort_array(collect_list({entry(f)})) AS {self._column(f)}" for f in facets]
        return combined.groupBy(*keys).agg(*self.measures(), *expressions(*arrays))

    def unfold(self, state: DataFrame, facets: Sequence[str] | None = None) -> DataFrame:
        """A state's rows as (keys, facet, value, member, n, sums, maxima): a total per row, and a row per pair and member."""
        held = self._held(state, facets)
        arrays = [self._column(f) for f in self.facets()]
        keys = [c for c in state.columns if c not in (*arrays, *self.sums, *self.maxes)]

        def row(facet: str, value: str, member: str, n: str, measured: bool) -> str:
            measures = [f"'{k}', {k if measured else 'CAST(NULL AS BIGINT)'}" for k in (*self.sums, *self.maxes)]
            return f"named_struct({', '.join([f"'facet', '{facet}', 'value', {value}, 'member', {member}, 'n', {n}", *measures])})"

        no_number, no_text = "CAST(NULL AS BIGINT)", "CAST(NULL AS STRING)"
        parts = [f"array({row(TOTAL, no_number, no_text, no_number, True)})"]
        for f in held:
            entry = row(f, "e.value", no_text, "e.n", False) if f in self.values else row(f, no_number, "e", "1L", False)
            parts.append(f"transform({self._column(f)}, e -> {entry})")
        return state.selectExpr(*keys, f"inline(concat({', '.join(parts)}))")

    def merge(
        self, state: DataFrame, keys: Sequence[str | Column] | None = None, facets: Sequence[str] | None = None
    ) -> DataFrame:
        """One row per group of ``keys``, the same grain or a coarser one, from the rows of any number of batches."""
        by, held = list(self.keys) if keys is None else list(keys), self._held(state, facets)
        if not held:
            return state.groupBy(*by).agg(*self.measures())
        return self._fold(self._combine(self.unfold(state, held), by), held)

    def finish(
        self,
        merged: DataFrame,
        quantiles: Mapping[str, Sequence[float]] | None = None,
        members: Sequence[str] | None = None,
    ) -> DataFrame:
        """Readable metrics from rows that hold each group once, row by row.

        Columns: the keys, the sums, the maxima, ``<value>_p<q>`` per wanted
        quantile (linear interpolation) and ``unique_<member>`` counts.
        """
        _, quantiles, members = self._wanted(None, quantiles, members)
        counted = merged.withColumns(
            {f"_last_{v}": F.expr(f"aggregate({v}_counts, -1L, (total, e) -> total + e.n)") for v in quantiles}
        )
        points = [f"{_point(v, q)} AS {v}_{quantile_label(q)}" for v, qs in quantiles.items() for q in qs]
        uniques = [f"CAST(size({m}_set) AS BIGINT) AS unique_{m}" for m in members]
        return counted.selectExpr(*self.keys, *self.sums, *self.maxes, *points, *uniques)

    def counted(self, quantiles: Mapping[str, Sequence[float]], members: Sequence[str]) -> list[Column]:
        """Aggregates over unfolded rows: the percentile arrays ``_q_<value>`` and ``unique_<member>``."""
        return expressions(
            *[f"percentile(CASE WHEN facet = '{v}' THEN value END, {_points(qs)}, n) AS _q_{v}" for v, qs in quantiles.items()],
            *[f"count_if(facet = '{m}' AND member IS NOT NULL) AS unique_{m}" for m in members],
        )

    def _finish_rows(
        self, rows: DataFrame, keys: Sequence[str], quantiles: Mapping[str, Sequence[float]], members: Sequence[str]
    ) -> DataFrame:
        """Readable metrics from unfolded rows that hold each member once per ``keys``."""
        done = rows.groupBy(*keys).agg(*self.measures(), *self.counted(quantiles, members))
        uniques = [f"unique_{m}" for m in members]
        return done.selectExpr(*keys, *self.sums, *self.maxes, *quantile_columns(quantiles), *uniques)

    def finalize(
        self,
        state: DataFrame,
        keys: Sequence[str] | None = None,
        quantiles: Mapping[str, Sequence[float]] | None = None,
        members: Sequence[str] | None = None,
    ) -> DataFrame:
        """Readable metrics from the rows of any number of batches, at ``keys`` or coarser.

        Sums and value counts add up without being merged first; only members
        seen in several rows must become one.
        """
        keys, quantiles, members = self._wanted(keys, quantiles, members)
        if not quantiles and not members:
            return state.groupBy(*keys).agg(*self.measures())
        rows = self.unfold(state, [*quantiles, *members])
        if members:
            rows = self._combine(rows, keys)
        return self._finish_rows(rows, keys, quantiles, members)

    def _wanted(
        self,
        keys: Sequence[str] | None,
        quantiles: Mapping[str, Sequence[float]] | None,
        members: Sequence[str] | None,
    ) -> tuple[list[str], dict[str, Sequence[float]], list[str]]:
        return (
            list(self.keys) if keys is None else list(keys),
            dict(self.quantiles if quantiles is None else quantiles),
            list(self.members if members is None else members),
        )

    # Sketch form: one row per key group holding KLL and HLL sketches, for
    # grains where value counts would be nearly as many as the requests.

    def sketch_state(self, requests: DataFrame) -> DataFrame:
        keyed = requests.select("*", *[F.expr(e).alias(f"_k_{k}") for k, e in self.keys.items()])
        return keyed.groupBy(*[F.col(f"_k_{k}").alias(k) for k in self.keys]).agg(
            *[F.sum(F.expr(e).cast("bigint")).alias(k) for k, e in self.sums.items()],
            *[F.max(F.expr(e).cast("bigint")).alias(k) for k, e in self.maxes.items()],
            *[F.kll_sketch_agg_bigint(F.expr(e).cast("bigint")).alias(f"{k}_kll") for k, e in self.values.items()],
            *[F.hll_sketch_agg(F.expr(e).cast("string")).alias(f"{k}_hll") for k, e in self.members.items()],
        )

    def sketch_merge(self, state: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
        return state.groupBy(*keys).agg(
            *[F.sum(k).alias(k) for k in self.sums],
            *[F.max(k).alias(k) for k in self.maxes],
            *[F.kll_merge_agg_bigint(f"{k}_kll").alias(f"{k}_kll") for k in self.values],
            *[F.hll_union_agg(f"{k}_hll").alias(f"{k}_hll") for k in self.members],
        )

    def sketch_finish(
        self,
        state: DataFrame,
        keys: Sequence[str] | None = None,
        quantiles: Mapping[str, Sequence[float]] | None = None,
    ) -> DataFrame:
        keys, quantiles, _ = self._wanted(keys, quantiles, ())
        points = [
            F.kll_sketch_get_quantile_bigint(f"{name}_kll", F.lit(float(q)))
            .cast("double")
            .alias(f"{name}_{quantile_label(q)}")
            for name, qs in quantiles.items()
            for q in qs
        ]
        uniques = [F.hll_sketch_estimate(f"{m}_hll").alias(f"unique_{m}") for m in self.members]
        return state.select(*keys, *self.sums, *self.maxes, *points, *uniques)
