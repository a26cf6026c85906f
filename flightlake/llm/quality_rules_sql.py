"""DuckDB SQL of operator 10: the same estimate as a chain of common table expressions."""

from __future__ import annotations

from flightlake.llm import quality_rules as q

_SEP = r"[\x20\x09-\x0D]"

_STATISTICS = rf"""
d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         coalesce('=' || lang, '') AS l, coalesce('=' || source, '') AS s FROM documents),
split AS MATERIALIZED (
  SELECT r, list_filter(regexp_split_to_array(t, '{_SEP}+'), lambda x: x <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
flat AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM split),
three AS (
  SELECT r, i, word AS a, lead(word, 1) OVER (PARTITION BY r ORDER BY i) AS b,
         lead(word, 2) OVER (PARTITION BY r ORDER BY i) AS c FROM flat),
again AS (SELECT r, i FROM (SELECT r, i, c, count(*) OVER (PARTITION BY r, a, b, c) AS k FROM three) WHERE c IS NOT NULL AND k > 1),
covered AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM again) GROUP BY r),
stats AS MATERIALIZED (
  SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM (
    SELECT d.r, doc_id, l, s, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
           CAST(len(ls) AS BIGINT) AS n_lines, CAST(length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS BIGINT) AS n_upper
    FROM d JOIN split USING (r) LEFT JOIN covered USING (r)))"""


def _share(part: str, whole: str) -> str:
    return f"ln(1 + 100.0 * CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE))"


_X = {"x_words": "ln(CAST(n_words AS DOUBLE))", "x_length": "ln(CAST(word_chars AS DOUBLE) / CAST(n_words AS DOUBLE))",
      "x_symbols": _share("n_symbols", "n_words"), "x_lines": _share("n_dup_lines", "n_lines"),
      "x_repeats": _share("n_repeat_words", "n_words"), "x_upper": _share("n_upper", "word_chars")}


def _whitened(name: str, source: str, floors: dict[str, float], factor: float) -> list[str]:
    """Centre and inverse Cholesky factor per pool from the sums of ``source``."""
    names, p = list(floors), len(floors)
    cols = [f"s_{j} / k AS m_{j}" for j in range(p)]
    raw = [f"q_{i}_{j} / k AS e_{i}_{j}" for i in range(p) for j in range(i + 1)]
    out = [f"{name}_a AS MATERIALIZED (SELECT pool, {', '.join(cols + raw)} FROM {source})"]
    cov = [f"CAST({factor!r} AS DOUBLE) * (e_{i}_{j} - m_{i} * m_{j}) + CAST({(floors[names[i]] * q.UNIT) ** 2 if i == j else 0.0!r} AS DOUBLE) AS c_{i}_{j}"
           for i in range(p) for j in range(i + 1)]
    out.append(f"{name}_c0 AS MATERIALIZED (SELECT *, {', '.join(cov)} FROM {name}_a)")
    for j in range(p):
        def rest(i: int, j: int = j) -> str:
            return f"c_{i}_{j}" + "".join(f" - l_{i}_{k} * l_{j}_{k}" for k in range(j))
        below = "".join(f", ({rest(i)}) / l_{j}_{j} AS l_{i}_{j}" for i in range(j + 1, p))
        out.append(f"{name}_c{j + 1} AS MATERIALIZED (SELECT *{below} FROM (SELECT *, sqrt({rest(j)}) AS l_{j}_{j} FROM {name}_c{j}))")
    last = f"{name}_c{p}"
    for i in range(p):
        row = [f"1.0 / l_{i}_{i} AS w_{i}_{i}"]
        row += [f"-({' + '.join(f'l_{i}_{k} * w_{k}_{j}' for k in range(j, i))}) / l_{i}_{i} AS w_{i}_{j}" for j in range(i)]
        out.append(f"{name}_w{i} AS MATERIALIZED (SELECT *, {', '.join(row)} FROM {last})")
        last = f"{name}_w{i}"
    out.append(f"{name} AS MATERIALIZED (SELECT * FROM {last})")
    return out


def _distance(names: list[str]) -> str:
    z = [" + ".join(f"w_{i}_{j} * ({names[j]} - m_{j})" for j in range(i + 1)) for i in range(len(names))]
    return " + ".join(f"({e}) * ({e})" for e in z)


def sql(floors: dict[str, float] = q.FLOORS, support: float = q.SUPPORT, steps: int = q.STEPS, tail: float = q.TAIL,
        min_rows: int = q.MIN_ROWS) -> str:
    names, p = list(floors), len(floors)
    xs = ", ".join(f"CASE WHEN NOT base_failed THEN CAST(round({e} * {q.UNIT}) AS BIGINT) END AS {n}" for n, e in _X.items())
    parts = [_STATISTICS.strip(), f"rows_x AS MATERIALIZED (SELECT *, {xs} FROM stats)",
             f"vectors AS MATERIALIZED (SELECT DISTINCT l, s, {', '.join(names)} FROM rows_x WHERE NOT base_failed)",
             "pairs AS (SELECT l, s, count(*) AS n FROM vectors GROUP BY l, s)",
             f"langs AS (SELECT l, sum(n) AS n_lang FROM pairs WHERE n < {min_rows} GROUP BY l)",
             f"rest AS (SELECT sum(n_lang) AS n_rest FROM langs WHERE n_lang < {min_rows})",
             f"pools AS MATERIALIZED (SELECT l, s, CASE WHEN n >= {min_rows} THEN '1' || l || chr(1) || s "
             f"WHEN n_lang >= {min_rows} THEN '2' || l WHEN n_rest >= {min_rows} THEN '3' END AS pool "
             "FROM pairs LEFT JOIN langs USING (l) CROSS JOIN rest)",
             f"fit AS MATERIALIZED (SELECT DISTINCT pool, {', '.join(names)} FROM vectors JOIN pools USING (l, s) WHERE pool IS NOT NULL)",
             f"mid AS MATERIALIZED (SELECT pool, {', '.join(f'quantile_cont({x}, 0.5) AS m_{j}' for j, x in enumerate(names))} FROM fit GROUP BY pool)",
             f"dev AS MATERIALIZED (SELECT pool, {', '.join(f'quantile_cont(abs({x} - m_{j}), 0.5) AS d_{j}' for j, x in enumerate(names))} "
             "FROM fit JOIN mid USING (pool) GROUP BY pool)"]
    one = [f"CAST(1 AS DOUBLE) / sqrt(pow(CAST(1.4826 AS DOUBLE) * d_{j}, 2) + CAST({(floors[x] * q.UNIT) ** 2!r} AS DOUBLE))" for j, x in enumerate(names)]
    cells = ", ".join(f"{one[i] if i == j else 'CAST(0 AS DOUBLE)'} AS w_{i}_{j}" for i in range(p) for j in range(i + 1))
    parts.append(f"m0 AS MATERIALIZED (SELECT mid.*, {cells} FROM mid JOIN dev USING (pool))")
    sums = [f"sum({x}) AS s_{j}" for j, x in enumerate(names)] + [
        f"sum({names[i]} * {names[j]}) AS q_{i}_{j}" for i in range(p) for j in range(i + 1)]
    total = [f"sum({c}) AS {c}" for c in ["k", *(f"s_{j}" for j in range(p)), *(f"q_{i}_{j}" for i in range(p) for j in range(i + 1))]]
    doubles = [f"CAST({c} AS DOUBLE) AS {c}" for c in ["k", *(f"s_{j}" for j in range(p)), *(f"q_{i}_{j}" for i in range(p) for j in range(i + 1))]]
    for t in range(1, steps + 1):
        parts.append(f"b{t} AS MATERIALIZED (SELECT pool, bin, count(*) AS k, {', '.join(sums)} FROM (SELECT fit.*, "
                     f"CAST(floor(ln({_distance(names)} + CAST(1e-6 AS DOUBLE)) * {q.BINS}) AS BIGINT) AS bin FROM fit JOIN m{t - 1} USING (pool)) GROUP BY pool, bin)")
        parts.append(f"n{t} AS MATERIALIZED (SELECT pool, {', '.join(doubles)} FROM (SELECT pool, {', '.join(total)} FROM (SELECT *, "
                     "coalesce(sum(k) OVER (PARTITION BY pool ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, "
                     f"sum(k) OVER (PARTITION BY pool) AS n FROM b{t}) WHERE before < CAST({support!r} AS DOUBLE) * n GROUP BY pool))")
        parts += _whitened(f"m{t}", f"n{t}", floors, q.consistency(support, p))
    cut = q.chi_square_point(tail, p)
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce({_distance(names)} <= CAST({cut!r} AS DOUBLE), TRUE) AS kept
FROM rows_x LEFT JOIN pools USING (l, s) LEFT JOIN m{steps} USING (pool)"""
