"""SPARQL queries to Spark SQL text."""

from __future__ import annotations

import itertools
from collections.abc import Callable
from dataclasses import dataclass, replace

from ...errors import TranslationError
from ...functions.lexical import name, quote
from .ast import Aggregate, Bgp, Bind, Exists, Filter, Group, Iri, Literal, Minus, Optional, Path, Select, Triple, Union, Values, Var
from .bgp import Bgps, no_rows
from .expressions import Expressions, Info, Value, aggregates_in, double, integer, is_numeric, lex, number, plain


@dataclass
class Solution:
    """SQL with a text column v_<variable> for each variable."""

    sql: str
    vars: dict[str, Info]


def column(var: str, alias: str = "") -> str:
    return f"{alias}.{name('v_' + var)}" if alias else name("v_" + var)


class Compiler:
    """closure: turns SQL of edges (columns cte_from, cte_to) into the name of a table of their transitive closure;
    without it, closures become recursive common table expressions of the text."""

    def __init__(self, bgps: Bgps, closure: Callable[[str], str] | None = None):
        self.bgps, self.closure = bgps, closure
        self.ctes: list[str] = []
        self.n = 0

    def alias(self, stem: str = "s") -> str:
        self.n += 1
        return f"{stem}{self.n}"

    # whole queries

    def query(self, q: Select) -> str:
        if q.ask:
            inner = self.where(q)
            sql = f"SELECT count(1) > 0 AS `ask` FROM (SELECT 1 FROM ({inner.sql}) LIMIT 1)"
        else:
            sql = self.select(q, top=True).sql
        return (f"WITH RECURSIVE {', '.join(self.ctes)} " if self.ctes else "") + sql

    def where(self, q: Select) -> Solution:
        out = self.group(q.where)
        if q.values is not None:
            out = self.join(out, self.values(q.values))
        return out

    def select(self, q: Select, top: bool = False) -> Solution:
        inner = self.where(q)
        computed = [e for _, e in q.items or () if e is not None]
        aggregates = list(dict.fromkeys(a for e in [*computed, *q.having, *[e for e, _ in q.order_by]] for a in aggregates_in(e)))
        known: dict[Aggregate, Value] | None = None
        if aggregates or q.group_by:
            if q.items is None:
                raise TranslationError("SELECT * can't be grouped")
            inner, known = self.grouped(inner, q.group_by, aggregates)
        elif q.having:
            raise TranslationError("HAVING needs GROUP BY or an aggregate")
        names = [n for n in inner.vars if n[0] != "%" and n[0] != "!"] if q.items is None else [n for n, _ in q.items]
        if len(set(names)) < len(names):
            raise TranslationError("a variable is selected twice")
        for n, e in q.items or ():  # AS, in order; later ones may use earlier ones
            if e is None:
                continue
            if n in inner.vars:
                raise TranslationError(f"variable ?{n} is bound already")
            inner, known = self.extended(inner, n, e, "SELECT", known)
        for e in q.having:
            alias = self.alias()
            test = self.expressions(inner, alias, "HAVING", known).truth(e)
            inner = Solution(f"SELECT * FROM ({inner.sql}) AS {alias} WHERE {test}", inner.vars)
        infos = {n: inner.vars.get(n, Info(optional=True)) for n in names}
        alias = self.alias()
        shown = ", ".join(f"{column(n, alias)} AS {column(n)}" if n in inner.vars else f"cast(NULL AS STRING) AS {column(n)}" for n in names) or "1 AS `_one`"
        over = inner
        sql = f"SELECT {'DISTINCT ' if q.distinct else ''}{shown} FROM ({inner.sql}) AS {alias}"
        if q.distinct and q.order_by:
            over = Solution(sql, infos)
            alias = self.alias()
            sql = f"SELECT * FROM ({over.sql}) AS {alias}"
        if q.order_by:
            known = None if q.distinct else known
            orders = []
            for e, down in q.order_by:
                v = self.expressions(over, alias, "ORDER BY", known).value(e)
                orders.append(f"{number(v).sql if is_numeric(v) else v.sql} {'DESC NULLS LAST' if down else 'ASC NULLS FIRST'}")
            sql += f" ORDER BY {', '.join(orders)}"
        if q.limit is not None:
            sql += f" LIMIT {q.limit}"
        if q.offset:
            sql += f" OFFSET {q.offset}"
        return Solution(sql, infos if top else {n: replace(i, optional=True) for n, i in infos.items()})

    def expressions(self, s: Solution, alias: str, where: str, aggregates: dict[Aggregate, Value] | None = None) -> Expressions:
        return Expressions({n: (column(n, alias), i) for n, i in s.vars.items()}, self.exists, aggregates, where)

    def extended(self, s: Solution, var: str, e, where: str, known: dict[Aggregate, Value] | None = None) -> tuple[Solution, dict[Aggregate, Value] | None]:
        alias = self.alias()
        v = self.expressions(s, alias, where, known).value(e)
        optional = any(s.vars[x].optional for x in _vars_of(e) if x in s.vars) or not isinstance(e, (Var, Iri, Literal))
        return Solution(f"SELECT {alias}.*, {lex(v)} AS {column(var)} FROM ({s.sql}) AS {alias}", {**s.vars, var: replace(v.info, optional=optional)}), known

    def grouped(self, s: Solution, keys: list[tuple[object, str | None]], aggregates: list[Aggregate]) -> tuple[Solution, dict[Aggregate, Value]]:
        alias = self.alias()
        over = self.expressions(s, alias, "GROUP BY")
        columns, by, infos = [], [], {}
        for i, (e, said) in enumerate(keys):
            v = over.value(e)
            var = said or (e.name if isinstance(e, Var) else f"!{i}")
            infos[var] = v.info
            columns.append(f"{lex(v)} AS {column(var)}")
            by.append(lex(v))
        known: dict[Aggregate, Value] = {}
        for i, a in enumerate(aggregates):
            sql, result = self.aggregate(a, over, s, alias)
            columns.append(f"{sql} AS `agg_{i}`")
            known[a] = replace(result, sql=f"`agg_{i}`")
        group = f" GROUP BY {', '.join(by)}" if by else ""
        return Solution(f"SELECT {', '.join(columns) or '1 AS `_one`'} FROM ({s.sql}) AS {alias}{group}", infos), known

    def aggregate(self, a: Aggregate, over: Expressions, s: Solution, alias: str) -> tuple[str, Value]:
        distinct = "DISTINCT " if a.distinct else ""
        if a.arg is None:
            row = f"struct({', '.join(column(n, alias) for n in s.vars)})" if a.distinct and s.vars else "1"
            return f"count({distinct}{row})", integer("")
        v = over.value(a.arg)
        text = lex(v)
        if a.name == "COUNT":
            return f"count({distinct}{text})", integer("")
        if a.name in ("SUM", "AVG"):
            x = number(v)
            if a.name == "SUM" and x.type == "int":
                return f"coalesce(sum({distinct}{x.sql}), 0L)", integer("")
            return f"coalesce({a.name.lower()}({distinct}{x.sql}), 0D)", double("")
        if a.name in ("MIN", "MAX"):
            if is_numeric(v):
                x = number(v)
                return f"{a.name.lower()}({x.sql})", x
            return f"{a.name.lower()}({text})", Value("", "str", v.info)
        if a.name == "SAMPLE":
            return f"min({text})", Value("", "str", v.info)
        items = f"array_sort({'collect_set' if a.distinct else 'collect_list'}({text}))"  # sorted: one result whatever the order of rows
        return f"array_join({items}, {quote(a.separator)})", plain("")

    # patterns

    def group(self, g: Group) -> Solution:
        out, filters = None, []
        for e in g.elements:
            if isinstance(e, Filter):
                filters.append(e.expr)
            elif isinstance(e, Optional):
                out = self.optional(out or unit(), e.group)
            elif isinstance(e, Minus):
                out = self.minus(out or unit(), self.group(e.group))
            elif isinstance(e, Bind):
                out = out or unit()
                if e.var in out.vars:
                    raise TranslationError(f"variable ?{e.var} is bound already")
                out, _ = self.extended(out, e.var, e.expr, "BIND")
            else:
                out = self.join(out, self.element(e))
        out = out or unit()
        for e in filters:
            out = self.filtered(out, e)
        return out

    def filtered(self, s: Solution, e) -> Solution:
        alias = self.alias()
        return Solution(f"SELECT * FROM ({s.sql}) AS {alias} WHERE {self.expressions(s, alias, 'FILTER').truth(e)}", s.vars)

    def element(self, e) -> Solution:
        if isinstance(e, Bgp):
            return self.bgp(e.triples)
        if isinstance(e, Group):
            return self.group(e)
        if isinstance(e, Union):
            return self.union([self.group(b) for b in e.branches])
        if isinstance(e, Values):
            return self.values(e)
        if isinstance(e, Select):
            return self.select(e)
        raise TranslationError(f"{type(e).__name__} is not supported")

    def bgp(self, triples: list[Triple]) -> Solution:
        flat = [t for t in triples if not isinstance(t.predicate, Path)]
        out = None
        if flat:
            found = self.bgps.select(flat)
            if found is not None:
                out = Solution(*found)
            else:
                for t in flat:
                    out = self.join(out, Solution(*self.bgps.select([t])))
        for t in triples:
            if isinstance(t.predicate, Path):
                out = self.join(out, self.path(t.subject, t.predicate, t.object))
        return out or unit()

    def shared(self, a: Solution, b: Solution, left: str, right: str) -> tuple[list[str], list[str]]:
        """Conditions of compatibility, and the columns of both."""
        on, columns = [], []
        for n in a.vars:
            x, y = column(n, left), column(n, right)
            if n not in b.vars:
                columns.append(f"{x} AS {column(n)}")
                continue
            loose = [f"{c} IS NULL" for c, s in ((x, a), (y, b)) if s.vars[n].optional]
            on.append(f"({' OR '.join([f'{x} = {y}', *loose])})")
            columns.append(f"{f'coalesce({x}, {y})' if a.vars[n].optional else x} AS {column(n)}")
        columns += [f"{column(n, right)} AS {column(n)}" for n in b.vars if n not in a.vars]
        return on, columns

    @staticmethod
    def both(a: Solution, b: Solution, optional: bool = False) -> dict[str, Info]:
        out = {}
        for n in [*a.vars, *[n for n in b.vars if n not in a.vars]]:
            x, y = a.vars.get(n), b.vars.get(n)
            if x is None:
                out[n] = replace(y, optional=y.optional or optional)
            elif y is None:
                out[n] = x
            else:
                out[n] = replace(x.merged(y), optional=x.optional and (y.optional or optional)) if x.optional else x
        return out

    def join(self, a: Solution | None, b: Solution) -> Solution:
        if a is None:
            return b
        for n in a.vars:
            if n in b.vars and (a.vars[n].optional or b.vars[n].optional):
                return self.join_in_parts(a, b)
        left, right = self.alias(), self.alias()
        on, columns = self.shared(a, b, left, right)
        how = f"JOIN ({b.sql}) AS {right} ON {' AND '.join(on)}" if on else f"CROSS JOIN ({b.sql}) AS {right}"
        return Solution(f"SELECT {', '.join(columns) or '1 AS `_one`'} FROM ({a.sql}) AS {left} {how}", self.both(a, b))

    def join_in_parts(self, a: Solution, b: Solution) -> Solution:
        """A join on variables that may be unbound: sides are split by which of them are bound, so that each part joins by equality."""
        loose = [n for n in a.vars if n in b.vars and (a.vars[n].optional or b.vars[n].optional)]
        infos, parts = self.both(a, b), []
        for bound_a in itertools.product(*[(True, False) if a.vars[n].optional else (True,) for n in loose]):
            for bound_b in itertools.product(*[(True, False) if b.vars[n].optional else (True,) for n in loose]):
                left, right = self.alias(), self.alias()
                on = [f"{column(n, left)} = {column(n, right)}" for n in a.vars if n in b.vars and n not in loose]
                on += [f"{column(n, left)} = {column(n, right)}" for n, x, y in zip(loose, bound_a, bound_b, strict=True) if x and y]
                sides = []
                for s, bound in ((a, bound_a), (b, bound_b)):
                    tests = [f"{column(n)} IS {'NOT ' if x else ''}NULL" for n, x in zip(loose, bound, strict=True) if s.vars[n].optional]
                    sides.append(f"(SELECT * FROM ({s.sql}) WHERE {' AND '.join(tests)})" if tests else f"({s.sql})")
                columns = [f"{f'coalesce({column(n, left)}, {column(n, right)})' if n in loose else column(n, left if n in a.vars else right)} AS {column(n)}" for n in infos]
                how = f"JOIN {sides[1]} AS {right} ON {' AND '.join(on)}" if on else f"CROSS JOIN {sides[1]} AS {right}"
                parts.append(f"SELECT {', '.join(columns)} FROM {sides[0]} AS {left} {how}")
        return Solution(" UNION ALL ".join(parts), infos)

    def optional(self, a: Solution, g: Group) -> Solution:
        filters = [e.expr for e in g.elements if isinstance(e, Filter)]
        b = self.group(Group([e for e in g.elements if not isinstance(e, Filter)]))
        left, right = self.alias(), self.alias()
        on, columns = self.shared(a, b, left, right)
        scope = {n: (column(n, right), i) for n, i in b.vars.items()}
        scope |= {n: (f"coalesce({column(n, left)}, {column(n, right)})" if n in b.vars else column(n, left), i) for n, i in a.vars.items()}
        plain = [e for e in filters if not _has_exists(e)]
        on += [Expressions(scope, None, None, "FILTER").truth(e) for e in plain]
        if len(plain) < len(filters):
            return self.optional_where(a, b, on, columns, left, right, [e for e in filters if _has_exists(e)])
        return Solution(f"SELECT {', '.join(columns) or '1 AS `_one`'} FROM ({a.sql}) AS {left} LEFT JOIN ({b.sql}) AS {right} ON {' AND '.join(on) or 'true'}", self.both(a, b, True))

    def optional_where(self, a: Solution, b: Solution, on: list[str], columns: list[str], left: str, right: str, filters: list) -> Solution:
        """OPTIONAL whose filters hold EXISTS, which no join condition can: the filtered join, and the rows of a that it leaves out."""
        infos, keys = self.both(a, b, True), [column(n) for n in a.vars]
        # equal rows of a go together, with their number
        grouped = f"SELECT {', '.join([*keys, 'count(1) AS `_times`'])} FROM ({a.sql}) GROUP BY {', '.join(keys)}" if keys else f"SELECT count(1) AS `_times` FROM ({a.sql})"
        joined = f"SELECT {', '.join([*columns, f'{left}.`_times` AS `_times`', *[f'{left}.{k} AS {name(f"_k{i}")}' for i, k in enumerate(keys)]])} FROM ({grouped}) AS {left} JOIN ({b.sql}) AS {right} ON {' AND '.join(on) or 'true'}"
        alias = self.alias()
        inner = Solution(joined, infos)
        test = " AND ".join(self.expressions(inner, alias, "FILTER").truth(e) for e in filters)
        found = f"SELECT * FROM ({joined}) AS {alias} WHERE {test}"
        l2, r2 = self.alias(), self.alias()
        same = " AND ".join(f"{l2}.{k} <=> {r2}.{name(f'_k{i}')}" for i, k in enumerate(keys)) or "true"
        shown = [f"coalesce({r2}.{column(n)}, {l2}.{column(n)}) AS {column(n)}" if n in a.vars else f"{r2}.{column(n)} AS {column(n)}" for n in infos]
        times = f"explode(sequence(1L, {l2}.`_times`)) AS `_time`"
        sql = f"SELECT {', '.join([*shown, times])} FROM ({grouped}) AS {l2} LEFT JOIN ({found}) AS {r2} ON {same}"
        return Solution(f"SELECT {', '.join(column(n) for n in infos) or '1 AS `_one`'} FROM ({sql})", infos)

    def minus(self, a: Solution, b: Solution) -> Solution:
        common = [n for n in a.vars if n in b.vars]
        if not common:
            return a
        left, right = self.alias(), self.alias()
        on, _ = self.shared(a, b, left, right)
        if all(a.vars[n].optional or b.vars[n].optional for n in common):
            on.append("(" + " OR ".join(f"{column(n, left)} = {column(n, right)}" for n in common) + ")")
        return Solution(f"SELECT {left}.* FROM ({a.sql}) AS {left} LEFT ANTI JOIN ({b.sql}) AS {right} ON {' AND '.join(on)}", a.vars)

    def exists(self, e: Exists, variables: dict[str, tuple[str, Info]]) -> str:
        inner = self.group(e.group)
        alias = self.alias()
        on = []
        for n, (outer, info) in variables.items():
            if n in inner.vars:
                mine = column(n, alias)
                loose = [f"{c} IS NULL" for c, o in ((outer, info.optional), (mine, inner.vars[n].optional)) if o]
                on.append(f"({' OR '.join([f'{outer} = {mine}', *loose])})")
        where = f" WHERE {' AND '.join(on)}" if on else ""
        return f"{'NOT ' if e.negated else ''}EXISTS (SELECT 1 FROM ({inner.sql}) AS {alias}{where})"

    def union(self, branches: list[Solution]) -> Solution:
        names = list(dict.fromkeys(n for b in branches for n in b.vars))
        parts, infos = [], {}
        for b in branches:
            alias = self.alias()
            columns = [f"{column(n, alias)} AS {column(n)}" if n in b.vars else f"cast(NULL AS STRING) AS {column(n)}" for n in names] or ["1 AS `_one`"]
            parts.append(f"SELECT {', '.join(columns)} FROM ({b.sql}) AS {alias}")
        for n in names:
            found = [b.vars[n] for b in branches if n in b.vars]
            info = found[0]
            for other in found[1:]:
                info = info.merged(other)
            infos[n] = replace(info, optional=info.optional or len(found) < len(branches))
        return Solution(" UNION ALL ".join(parts), infos)

    def values(self, v: Values) -> Solution:
        infos: dict[str, Info] = {}
        for i, n in enumerate(v.vars):
            terms = [row[i] for row in v.rows]
            known = [Info(frozenset("I"), None, None, True) if isinstance(t, Iri) else Info(frozenset("L"), t.datatype, t.lang, True) for t in terms if t is not None]
            info = known[0] if known else Info()
            for other in known[1:]:
                info = info.merged(other)
            infos[n] = replace(info, optional=None in terms)
        if not v.rows:
            return Solution(no_rows(v.vars), infos)
        if not v.vars:
            return Solution(f"SELECT 1 AS `_one` FROM VALUES {', '.join('(1)' for _ in v.rows)} AS t(x)", {})
        said = lambda t: "cast(NULL AS STRING)" if t is None else quote(t.value)
        rows = ", ".join(f"({', '.join(said(t) for t in row)})" for row in v.rows)
        return Solution(f"SELECT * FROM VALUES {rows} AS {self.alias()}({', '.join(column(n) for n in v.vars)})", infos)

    # paths

    def path(self, s, p, o) -> Solution:
        """A path between two terms: as joins and unions of patterns, closures by recursion."""
        if isinstance(p, Iri):
            return self.bgp([Triple(s, p, o)])
        if p.op == "^":
            return self.path(o, p.parts[0], s)
        if p.op == "/":
            out, at = None, s
            for i, part in enumerate(p.parts):
                to = o if i == len(p.parts) - 1 else Var(f"%p{self.alias('')}")
                out = self.join(out, self.path(at, part, to))
                at = to
            return out
        if p.op == "|":
            return self.union([self.path(s, part, o) for part in p.parts])
        if p.op == "!":
            return self.negated(s, p, o)
        x, y = Var(f"%p{self.alias('')}"), Var(f"%p{self.alias('')}")
        step = self.path(x, p.parts[0], y)
        edges = f"SELECT DISTINCT {column(x.name)} AS cte_from, {column(y.name)} AS cte_to FROM ({step.sql})"
        parts = []
        if p.op == "?":
            parts.append(edges)
        else:
            parts.append(f"SELECT cte_from, cte_to FROM {self.closed(edges)}")
        if p.op in "?*":
            parts.append(self.identity(s, o))
        info = {x.name: replace(step.vars[x.name], optional=False), y.name: replace(step.vars[y.name], optional=False)}
        sql = f"SELECT DISTINCT cte_from AS {column(x.name)}, cte_to AS {column(y.name)} FROM ({' UNION ALL '.join(parts)})"
        if p.op in "?*":
            info = {x.name: Info(), y.name: Info()}
        return self.ends(Solution(sql, info), (x.name, s), (y.name, o))

    def ends(self, pairs: Solution, *ends) -> Solution:
        """Rename a path's ends to the terms that the pattern has there."""
        alias, columns, tests, infos = self.alias(), [], [], {}
        for inner, term in ends:
            at = column(inner, alias)
            if not isinstance(term, Var):
                tests.append(f"{at} = {quote(term.value)}")
            elif term.name in infos:
                tests.append(f"{at} = {column(ends[0][0], alias)}")
            else:
                columns.append(f"{at} AS {column(term.name)}")
                infos[term.name] = pairs.vars[inner]
        where = f" WHERE {' AND '.join(tests)}" if tests else ""
        return Solution(f"SELECT {', '.join(columns) or '1 AS `_one`'} FROM ({pairs.sql}) AS {alias}{where}", infos)

    def closed(self, edges: str) -> str:
        """The name of a table of the edges' transitive closure."""
        if self.closure is not None:
            return self.closure(edges)
        e, c = self.alias("edges"), self.alias("closure")
        self.ctes.append(f"{e} AS ({edges})")
        self.ctes.append(
            f"{c} AS (SELECT cte_from, cte_to, array(cte_to) AS seen FROM {e} UNION ALL "
            f"SELECT {c}.cte_from, {e}.cte_to, array_append({c}.seen, {e}.cte_to) FROM {c} JOIN {e} ON {c}.cte_to = {e}.cte_from WHERE NOT array_contains({c}.seen, {e}.cte_to))"
        )
        return c

    def identity(self, s, o) -> str:
        """Paths of length zero: every term of the data, and the terms that the pattern names."""
        sub, pred, obj = (Var(f"%p{self.alias('')}") for _ in range(3))
        everything = self.bgp([Triple(sub, pred, obj)])
        parts = [f"SELECT {column(v.name)} AS n FROM ({everything.sql})" for v in (sub, obj)]
        parts += [f"SELECT {quote(t.value)} AS n" for t in (s, o) if not isinstance(t, Var)]
        return f"SELECT DISTINCT n AS cte_from, n AS cte_to FROM ({' UNION ALL '.join(parts)})"

    def negated(self, s, p: Path, o) -> Solution:
        """Any predicate but those named, forwards or (for inverse members) backwards."""
        forward = [x.value for x in p.parts if isinstance(x, Iri)]
        backward = [x.parts[0].value for x in p.parts if isinstance(x, Path)]
        out = []
        for names, (a, b) in ((forward, (s, o)), (backward, (o, s))):
            if names or not backward and a is s:
                var = Var(f"%p{self.alias('')}")
                found = self.bgp([Triple(a, var, b)])
                alias = self.alias()
                keep = ", ".join(column(n, alias) for n in found.vars if n != var.name) or "1 AS `_one`"
                sql = f"SELECT {keep} FROM ({found.sql}) AS {alias} WHERE {column(var.name, alias)} NOT IN ({', '.join(quote(n) for n in names)})"
                out.append(Solution(sql, {n: i for n, i in found.vars.items() if n != var.name}))
        return out[0] if len(out) == 1 else self.union(out)


def _has_exists(e) -> bool:
    return isinstance(e, Exists) or any(_has_exists(x) for x in getattr(e, "args", ()))


def unit() -> Solution:
    """One solution without variables."""
    return Solution("SELECT 1 AS `_one`", {})


def _vars_of(e) -> set[str]:
    if isinstance(e, Var):
        return {e.name}
    return {v for x in getattr(e, "args", ()) for v in _vars_of(x)}
