"""Pipeline stages Spark ML lacks. They persist like built-in ones; fitted state is one JSON parameter."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.columns import quoted, require
from riskflow.operators.encoding import LabelDomain, few_values, fit_label_encoder, unknown_name
from riskflow.plans.lookup import Lookup, TableSize, lookup_many
from riskflow.plans.shared import new_path

#: Mark of a sparse vector column that holds only 0 and 1, and the most slots a vector can have.
TWO_VALUED = "two_valued"
MAX_SLOTS = 2**31 - 1


class ColumnSelector(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Stops with a clear message when an input column is absent; further columns pass through."""

    @keyword_only
    def __init__(self, inputCols: Sequence[str] | None = None) -> None:
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        require(dataset, self.getInputCols())
        return dataset


class _HasState(Params):
    state = Param(Params._dummy(), "state", "fitted values as JSON", TypeConverters.toString)

    def fitted(self) -> dict:
        return json.loads(self.getOrDefault(self.state))


def _number(name: str) -> Column:
    """The column as a double; bad text and NaN become null."""
    value = F.col(quoted(name)).try_cast("double")
    return F.when(~F.isnan(value), value)


class FeatureVector(Transformer, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Joins array columns, and sparse vectors among them, into one vector column, in the order given.

    Arrays are converted once per row, together; vectors per part would be converted and then
    copied again. With a sparse vector among the parts the result is sparse where that is smaller.
    Classifiers learn here which slots hold only 0 and 1, so the driver names every slot.
    """

    @keyword_only
    def __init__(self, inputCols: Sequence[str] | None = None, outputCol: str | None = None) -> None:
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        runs: list[list[str]] = []  # neighbouring arrays, or one vector
        kinds: list[bool] = []
        for part in self.getInputCols():
            is_array = isinstance(dataset.schema[part].dataType, T.ArrayType)
            if is_array and kinds and kinds[-1]:
                runs[-1].append(part)
            else:
                runs.append([part])
                kinds.append(is_array)
        vectors = [
            array_to_vector(F.concat(*run) if len(run) > 1 else F.col(run[0])) if is_array else F.col(run[0])
            for run, is_array in zip(runs, kinds)
        ]
        names = [f"_part{i}" for i in range(len(vectors))] if len(vectors) > 1 else [self.getOutputCol()]
        parts = dataset.withColumns(dict(zip(names, vectors)))
        for run, name in zip(runs, names):
            known = dataset.schema[run[0]].metadata
            if known.get(TWO_VALUED):
                width = known["ml_attr"]["num_attrs"]
                slots = {"attrs": {"binary": [{"idx": i} for i in range(width)]}, "num_attrs": width}
                parts = parts.withMetadata(name, {"ml_attr": slots})
        if len(vectors) == 1:
            return parts
        return VectorAssembler(inputCols=names, outputCol=self.getOutputCol()).transform(parts).drop(*names)


class NumericFeatures(Estimator, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Coerce to numbers, fill by the mean, standardise by the population deviation; one pass to fit."""

    @keyword_only
    def __init__(self, inputCols: Sequence[str] | None = None, outputCol: str | None = None) -> None:
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> NumericFeaturesModel:
        return self.model_of(dataset.agg(*self.aggregates()).first())

    def aggregates(self) -> list[Column]:
        """What model_of() reads from one row over the data."""
        aggs = [F.count(F.lit(1)).alias("rows")]
        for i, c in enumerate(self.getInputCols()):
            x = _number(c)
            aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}")]
        return aggs

    def model_of(self, row: Row) -> NumericFeaturesModel:
        names = self.getInputCols()
        empty = [c for i, c in enumerate(names) if not row[f"n{i}"]]
        if empty:
            raise ValueError(f"no number to impute from in {', '.join(empty)}")
        means = [row[f"m{i}"] for i in range(len(names))]
        # filled rows sit on the mean, so they only add to the count below the variance
        scales = [math.sqrt(row[f"v{i}"] * row[f"n{i}"] / row["rows"]) or 1.0 for i in range(len(names))]
        model = NumericFeaturesModel(inputCols=names, outputCol=self.getOutputCol())
        return model._set(state=json.dumps({"means": means, "scales": scales}))


class NumericFeaturesModel(Model, HasInputCols, HasOutputCol, _HasState, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols: Sequence[str] | None = None, outputCol: str | None = None) -> None:
        super().__init__()
        self._set(**self._input_kwargs)

    def feature_names(self) -> list[str]:
        return list(self.getInputCols())

    def _transform(self, dataset: DataFrame) -> DataFrame:
        found = self.fitted()
        values = [
            (F.coalesce(_number(c), F.lit(mean)) - F.lit(mean)) / F.lit(scale)
            for c, mean, scale in zip(self.getInputCols(), found["means"], found["scales"])
        ]
        return dataset.withColumn(self.getOutputCol(), F.array(*values))


class OneHotFeatures(Estimator, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """One slot per value; ``drop`` leaves out the first value, ``indicator`` adds a slot for unknown ones.

    Up to ``maxDense`` values of all columns together, the model keeps them and gives an array of
    0 and 1. Beyond, the values stay a stored table: the model knows only how many there
    are, a row's slot comes from a join with that table, and the output is a sparse vector.
    """

    drop = Param(Params._dummy(), "drop", "first, or empty to keep all", TypeConverters.toString)
    unknown = Param(Params._dummy(), "unknown", "indicator or ignore", TypeConverters.toString)
    maxDense = Param(Params._dummy(), "maxDense", "values up to which the output is an array", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self,
        inputCols: Sequence[str] | None = None,
        outputCol: str | None = None,
        drop: str = "",
        unknown: str = "indicator",
        maxDense: int = 8192,
    ) -> None:
        super().__init__()
        self._setDefault(drop="", unknown="indicator", maxDense=8192)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> OneHotFeaturesModel:
        names = self.getInputCols()
        require(dataset, names)
        texts = few_values(dataset, names, self.getOrDefault(self.maxDense))
        return self.model_of(dataset, texts)

    def model_of(self, dataset: DataFrame, texts: Mapping[str, Sequence[str]] | None) -> OneHotFeaturesModel:
        """The model of values that few_values() has found already; None if they are too many."""
        names = self.getInputCols()
        first = 1 if self.getOrDefault(self.drop) == "first" else 0
        types = {c: dataset.schema[c].dataType.simpleString() for c in names}
        state = {"unknown": self.getOrDefault(self.unknown)}
        if texts is None:
            domain = fit_label_encoder(dataset, names)
            path = new_path(dataset.sparkSession, "domain")
            domain.table.write.parquet(f"{path}/values")
            columns = [
                {"family": domain.families[c], "type": types[c], "size": [domain.sizes[c].rows, domain.sizes[c].bytes, domain.sizes[c].weight]}
                for c in names
            ]
            state["wide"] = {"path": path, "first": first, "columns": columns}
        else:
            state["slots"] = [{"values": texts[c], "shown": texts[c][first:], "type": types[c]} for c in names]
        model = OneHotFeaturesModel(inputCols=names, outputCol=self.getOutputCol())
        return model._set(state=json.dumps(state))


class _WithDomainWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        domain = self.instance.domain()
        if domain is not None:
            domain.table.write.mode("overwrite").parquet(f"{path}/domain/values")


class _WithDomainReader(DefaultParamsReader):
    def load(self, path: str) -> OneHotFeaturesModel:
        model = super().load(path)
        state = model.fitted()
        if "wide" in state:
            state["wide"]["path"] = f"{path}/domain"
            model._set(state=json.dumps(state))
        return model


class OneHotFeaturesModel(Model, HasInputCols, HasOutputCol, _HasState, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols: Sequence[str] | None = None, outputCol: str | None = None) -> None:
        super().__init__()
        self._set(**self._input_kwargs)

    def write(self) -> DefaultParamsWriter:
        return _WithDomainWriter(self)

    @classmethod
    def read(cls) -> DefaultParamsReader:
        return _WithDomainReader(cls)

    def domain(self) -> LabelDomain | None:
        """The stored values of a model that has too many to keep itself."""
        wide = self.fitted().get("wide")
        if wide is None:
            return None
        table = SparkSession.active().read.parquet(f"{wide['path']}/values")
        columns = dict(zip(self.getInputCols(), wide["columns"]))
        return LabelDomain(
            table,
            {c: found["family"] for c, found in columns.items()},
            {c: found["type"] for c, found in columns.items()},
            {c: TableSize(*found["size"]) for c, found in columns.items()},
        )

    def _widths(self) -> list[int]:
        """Slots of each column, the one for unknown values included."""
        found = self.fitted()
        extra = 1 if found["unknown"] == "indicator" else 0
        if "wide" in found:
            return [max(c["size"][0] - found["wide"]["first"], 0) + extra for c in found["wide"]["columns"]]
        return [len(s["shown"]) + extra for s in found["slots"]]

    def n_slots(self) -> int:
        return sum(self._widths())

    def feature_names(self) -> list[str]:
        found = self.fitted()
        if "wide" in found:
            raise ValueError("the names of so many values are a table: see feature_table()")
        names = []
        for c, s in zip(self.getInputCols(), found["slots"]):
            names += [f"{c}_{v}" for v in s["shown"]]
            if found["unknown"] == "indicator":
                names.append(unknown_name(c, s["values"]))
        return names

    def feature_table(self) -> DataFrame:
        """(slot, feature) rows, slots from 0."""
        found = self.fitted()
        spark = SparkSession.active()
        domain = self.domain()
        if domain is None:
            return spark.createDataFrame(list(enumerate(self.feature_names())), "slot bigint, feature string")
        first, begin, parts, extra = found["wide"]["first"], 0, [], []
        for c, width in zip(self.getInputCols(), self._widths()):
            text = F.concat(F.lit(f"{c}_"), F.col("value").cast(domain.types[c]).cast("string"))
            shown = domain.of(c).where(F.col("code") >= first)
            parts.append(shown.select((F.col("code") + (begin - first)).alias("slot"), text.alias("feature")))
            begin += width
            if found["unknown"] == "indicator":
                extra.append((begin - 1, self._unknown_name(c, domain)))
        if extra:
            parts.append(spark.createDataFrame(extra, "slot bigint, feature string"))
        return reduce(DataFrame.unionByName, parts)

    def _unknown_name(self, column: str, domain: LabelDomain) -> str:
        """unknown_name() without the values: only those that begin alike are looked at."""
        text = F.col("value").cast(domain.types[column]).cast("string")
        alike = domain.of(column).where(text.rlike("^unknown_*$")).select(F.length(text).alias("n"))
        taken = {r["n"] for r in alike.orderBy("n").limit(1000).collect()}
        name = "unknown"
        while len(name) in taken:
            name += "_"
        return f"{column}_{name}"

    def _transform(self, dataset: DataFrame) -> DataFrame:
        found = self.fitted()
        if "wide" in found:
            return self._sparse(dataset, found)
        entries = []
        for c, slot in zip(self.getInputCols(), found["slots"]):
            value = fitted_text(dataset, c, slot["type"])
            # one expression for all values: its code does not grow with their number
            shown = F.lit(slot["shown"]) if slot["shown"] else F.array().cast("array<string>")
            entries.append(F.transform(shown, _equals(value)))
            if found["unknown"] == "indicator":
                seen = F.coalesce(value.isin(slot["values"]), F.lit(False)) if slot["values"] else F.lit(False)
                entries.append(F.array(F.when(seen, F.lit(0.0)).otherwise(F.lit(1.0))))
        return dataset.withColumn(self.getOutputCol(), F.concat(*entries) if len(entries) > 1 else entries[0])

    def _sparse(self, dataset: DataFrame, found: Mapping) -> DataFrame:
        """A sparse vector with the slots of all columns."""
        domain, first = self.domain(), found["wide"]["first"]
        lookups, slots, begin = [], [], 0
        for i, (c, width) in enumerate(zip(self.getInputCols(), self._widths())):
            value = fitted_value(dataset, c, domain.types[c])
            family = domain.table.schema[domain.families[c]].dataType
            lookups.append(Lookup(f"_code{i}", value.cast(family), domain.of(c), "value", "code", "n", domain.sizes[c]))
            code = F.col(f"_code{i}")
            unknown = F.lit(begin + width - 1) if found["unknown"] == "indicator" else F.lit(None).cast("bigint")
            slots.append(F.when(code.isNull(), unknown).when(code >= first, code + (begin - first)))
            begin += width
        if begin > MAX_SLOTS:
            raise ValueError(f"{begin} slots, more than the {MAX_SLOTS} a vector can have")
        places = F.array_compact(F.array(*slots))
        ones = F.transform(places, lambda _: F.lit(1.0))
        parts = F.struct(F.lit(0).alias("type"), F.lit(begin).alias("size"), places.alias("indices"), ones.alias("values"))
        # a vector from its own form: encoder and assembler would name each slot in the column's metadata on the driver
        kind = T.StructType().add("vector", VectorUDT())
        vector = F.from_json(F.to_json(F.struct(parts.alias("vector"))), kind, {"mode": "FAILFAST"})["vector"]
        coded = lookup_many(dataset, lookups).withColumn(self.getOutputCol(), vector)
        coded = coded.drop(*[item.out for item in lookups])
        return coded.withMetadata(self.getOutputCol(), {"ml_attr": {"num_attrs": begin}, TWO_VALUED: True})


def _equals(value: Column):
    """1.0 where an element equals the value, which may be null."""
    return lambda element: F.coalesce((element == value).cast("double"), F.lit(0.0))


def fitted_value(dataset: DataFrame, column: str, kind: str) -> Column:
    """A value in the type the fit saw, if it survives the way there and back; NaN counts as missing."""
    value = F.col(quoted(column))
    now = dataset.schema[column].dataType.simpleString()
    if now != kind:
        there = value.try_cast(kind)
        value = F.when(there.try_cast(now) == value, there) if now != "string" else there
    if kind in ("float", "double"):
        value = F.when(~F.isnan(value), value + F.lit(0.0).cast(kind))
    return value


def fitted_text(dataset: DataFrame, column: str, kind: str) -> Column:
    """fitted_value() as text."""
    return fitted_value(dataset, column, kind).cast("string")
