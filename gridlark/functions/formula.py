"""One definition of a function, three ways to run it on Spark.

A formula is SQL text over named arguments, optionally split into steps: each
step names values computed from the ones before.  Written as one expression,
a value used twice would be spelled out twice and the tree would double at
every step, so the steps are kept apart:

* ``formula.add(df, out, ...)`` runs every step as a projection of its own.
  All of them share one generated method chain in the stage (no Python, no
  lambdas).  This is the form for big tables.
* ``formula(...)`` gives a ``Column`` (steps bound by ``transform`` lambdas):
  usable anywhere an expression is, but interpreted.
* ``formula.register(spark)`` makes a SQL function of it.
"""

from __future__ import annotations

import re
from string import Formatter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Arg = Column | str | int | float

_TYPE_OF_NAME = re.compile(r"^[A-Za-z_]\w*$")


def names_in(text: str) -> set[str]:
    return {field for _, field, _, _ in Formatter().parse(text) if field}


def sql_text(arg: str | int | float) -> str:
    """SQL text of an argument: strings are names or SQL expressions, numbers literals."""
    if isinstance(arg, bool):
        return str(arg).lower()
    if isinstance(arg, float):
        return f"{arg!r}D"
    if isinstance(arg, int):
        return f"{arg}L"
    return f"`{arg}`" if _TYPE_OF_NAME.match(arg) else f"({arg})"


class Cut(dict):
    """A step with one value that also cuts the generated code into two methods.

    The JIT leaves methods beyond 8000 bytes of bytecode uncompiled.  Passing one
    value through a one-element ``explode`` makes Spark start a new method there.
    """


class Loop(dict):
    """A step repeated for ``{k}`` = first, first+by, .. last: values start at ``init``.

    Projections unroll it, with a cut (see ``Cut``) every few turns; the expression
    form folds it with ``aggregate``.
    """

    def __init__(self, first: int, last: int, by: int, init: dict[str, str], body: dict[str, str]):
        super().__init__(body)
        self.first, self.last, self.by, self.init = first, last, by, init
        self.cut_every = 8

    def together(self, other: Loop) -> Loop:
        both = Loop(self.first, self.last, self.by, self.init | other.init, {**self, **other})
        both.cut_every = self.cut_every // 2  # twice the code per turn
        return both

    def reads(self) -> set[str]:
        used = {n for text in (*self.values(), *self.init.values()) for n in names_in(text)}
        return used - self.keys() - {"k"} | {n for t in self.init.values() for n in names_in(t)}


class Formula:
    def __init__(
        self,
        name: str,
        args: dict[str, str],
        returns: str,
        result: str,
        steps: list[dict[str, str]] | None = None,
    ):
        self.name, self.args, self.returns = name, args, returns
        self.result, self.steps = result, steps or []
        # values that must be handed on after each step, found from the last one back
        self._live: list[set[str]] = []
        needed = names_in(result)
        for step in reversed(self.steps):
            self._live.append(needed)
            if isinstance(step, Loop):
                needed = (needed - step.keys()) | step.reads()
            else:
                needed = (needed - step.keys()) | {
                    n for key in step.keys() & needed for n in names_in(step[key])
                }
        self._live.reverse()

    def _handed_on(self, k: int) -> dict[str, str]:
        """Step ``k`` restricted to what is used later, plus older values still needed."""
        step = self.steps[k]
        return {n: step.get(n, "{" + n + "}") for n in sorted(self._live[k])}

    # -- expression form -----------------------------------------------------
    def _body(self, k: int, env: dict[str, str]) -> str:
        if k == len(self.steps):
            return self.result.format(**env)
        step = self.steps[k]
        if isinstance(step, Loop):
            start = ", ".join(f"'{n}', {t.format(**env)}" for n, t in step.init.items())
            inside = env | {n: f"a{k}.{n}" for n in step} | {"k": f"k{k}"}
            turn = ", ".join(f"'{n}', {step[n].format(**inside)}" for n in step.init)
            folded = (
                f"aggregate(sequence({step.first}, {step.last}, {step.by}), named_struct({start}), "
                f"(a{k}, k{k}) -> named_struct({turn}))"
            )
            rest = "".join(f", '{n}', {env[n]}" for n in sorted(self._live[k] - step.keys()))
            one = f"named_struct('r', {folded}{rest})"
            inner = {n: f"s{k}.r.{n}" if n in step else f"s{k}.{n}" for n in self._live[k]}
            return f"transform(array({one}), s{k} -> {self._body(k + 1, inner)})[0]"
        fields = ", ".join(
            f"'{n}', {text.format(**env)}" for n, text in self._handed_on(k).items()
        )
        inner = {n: f"s{k}.{n}" for n in self._live[k]}
        return f"transform(array(named_struct({fields})), s{k} -> {self._body(k + 1, inner)})[0]"

    def sql(self, *args: str | int | float) -> str:
        """SQL text of the call; string arguments are column names or SQL expressions."""
        env = {n: f"CAST({sql_text(a)} AS {t})" for (n, t), a in zip(self.args.items(), args, strict=True)}
        return f"CAST({self._body(0, env)} AS {self.returns})"

    def __call__(self, *args: Arg) -> Column:
        if not any(isinstance(a, Column) for a in args):
            return F.expr(self.sql(*args))
        fields = [
            (a if isinstance(a, Column) else F.expr(sql_text(a))).cast(t).alias(n)
            for (n, t), a in zip(self.args.items(), args, strict=True)
        ]
        body = self._body(0, {n: f"arg.{n}" for n in self.args})
        one = F.call_function("transform", F.array(F.struct(*fields)), F.expr(f"arg -> {body}"))
        return one[0].cast(self.returns)

    # -- staged form ---------------------------------------------------------
    def add(self, df: DataFrame, out: str, *args: str | int | float) -> DataFrame:
        """``df`` with column ``out``; string arguments are column names or SQL expressions.

        The result goes through a one-element ``explode``: the optimizer will not
        move a filter or join condition on ``out`` below it, which would repeat the
        steps inside the condition.  Filters on other columns still move down.
        """
        keep = [f"`{c}`" for c in df.columns if c != out]
        if not self.steps:
            return df.selectExpr(*keep, f"{self.sql(*args)} AS `{out}`")
        env = {}
        layers = []
        for (n, t), a in zip(self.args.items(), args, strict=True):
            env[n] = f"`_a_{n}`"
            layers.append(f"CAST({sql_text(a)} AS {t}) AS `_a_{n}`")
        layers = [layers]
        for k, step in enumerate(self.steps):
            if isinstance(step, Loop):
                env = self._unrolled(layers, k, step, env)
                continue
            after = {n: f"`_{k}_{n}`" for n in self._live[k]}
            form = "explode(array({}))" if isinstance(step, Cut) else "{}"
            layers.append(
                [
                    (form.format(text.format(**env)) if n in step else env[n]) + f" AS {after[n]}"
                    for n, text in self._handed_on(k).items()
                ]
            )
            env = after
        layers.append([f"explode(array(CAST({self.result.format(**env)} AS {self.returns}))) AS `{out}`"])
        # one statement, so that Spark analyzes all the layers in one go
        text = "{_source}"
        for layer in layers:
            exprs = ", ".join(e.replace("{", "{{").replace("}", "}}") for e in (*keep, *layer))
            text = f"(SELECT {exprs} FROM {text})"
        return df.sparkSession.sql(text[1:-1], _source=df)

    def _unrolled(self, layers: list[list[str]], k: int, step: Loop, env: dict[str, str]) -> dict[str, str]:
        outside = {n: env[n] for n in sorted((self._live[k] | step.reads()) - step.keys())}
        turns = [step.init] + [
            {n: t.replace("{k}", str(v)) for n, t in step.items()}
            for v in range(step.first, step.last + (1 if step.by > 0 else -1), step.by)
        ]
        for turn, texts in enumerate(turns):
            after = {n: f"`_{k}_{turn}_{n}`" for n in step}
            exprs = [t.format(**env) for t in texts.values()]
            if turn and turn % step.cut_every == 0:
                exprs[0] = f"explode(array({exprs[0]}))"
            named = (f"{e} AS {after[n]}" for e, n in zip(exprs, texts, strict=True))
            layers.append([*outside.values(), *named])
            env = outside | after
        return env

    # -- SQL name ------------------------------------------------------------
    def register(self, spark: SparkSession) -> None:
        params = ", ".join(f"{n} {t.upper()}" for n, t in self.args.items())
        body = self._body(0, {n: n for n in self.args})
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {self.name}({params}) "
            f"RETURNS {self.returns.upper()} RETURN {body}"
        )
