"""The quality rules as SQL: the same steps, written out."""

from tidemark.llm.quality_rules import (
    COVER, FALL, FINE, FLOOR, GRID, INSIDE, LOWER, MAX_REPEAT, MEANS, MIN_WORDS, P, PAIRS, RINGS, TAIL, WIDTHS,
    XS, chi_square_point, consistency,
)

SPACES = r"\x20\x09-\x0D"

STATISTICS = rf"""
docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
        coalesce('=' || lang, '') || chr(31) || coalesce('=' || source, '') AS g,
        regexp_extract_all(coalesce(text, ''), '[^{SPACES}]+') AS w
    FROM documents),
windows AS (
    SELECT r, i, list_slice(w, i, i + 4) AS k
    FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM docs)),
again AS (
    SELECT r, count(DISTINCT i + j) AS n FROM windows
    JOIN (SELECT r, k FROM windows GROUP BY ALL HAVING count(*) > 1) USING (r, k), range(5) s(j)
    GROUP BY r),
lines AS (
    SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS dup
    FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs)
    WHERE regexp_matches(line, '[^{SPACES}]') GROUP BY r),
statistics AS (
    SELECT r, doc_id, g, len(w) AS n_words,
        length(regexp_replace(t, '[{SPACES}]', '', 'g')) AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(lines.dup, 0) AS n_dup_lines, coalesce(again.n, 0) AS n_repeat_words
    FROM docs LEFT JOIN again USING (r) LEFT JOIN lines USING (r)),
rows AS MATERIALIZED (
    SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words AS base_failed,
        floor(ln(1e0 + n_words) * {GRID} + 0.5e0) AS x1,
        floor(word_chars / greatest(n_words, 1) * {GRID} + 0.5e0) AS x2,
        floor(sqrt(n_symbols / greatest(word_chars, 1)) * {GRID} + 0.5e0) AS x3,
        floor(ln(1e0 + n_dup_lines) * {GRID} + 0.5e0) AS x4,
        floor(n_repeat_words / greatest(n_words, 1) * {GRID} + 0.5e0) AS x5
    FROM statistics),
points AS MATERIALIZED (SELECT DISTINCT g, x1, x2, x3, x4, x5 FROM rows WHERE NOT base_failed)"""


def _distance() -> str:
    """Squared distance, with z0 to z4 as columns that build on one another."""
    z = []
    for i in range(P):
        rest = f"{XS[i]} - {MEANS[i]}" + "".join(f" - l{i}{j} * z{j}" for j in range(i))
        z.append(f"({rest}) / l{i}{i} AS z{i}")
    return ", ".join(z)


SQUARES = " + ".join(f"z{i} * z{i}" for i in range(P))


ESTIMATE = ", ".join([*MEANS, *LOWER])
SUMS = ", ".join([f"sum({x}) AS {x}" for x in XS] + [f"sum({XS[i]} * {XS[j]}) AS s{i}{j}" for i, j in PAIRS])


def _factor(covariance: list[str], source: str, kept: str) -> str:
    """``kept``, the factor's columns and the determinant, from the covariance's columns."""
    factor, det = [], "1e0"
    for j in range(P):
        own = f"c{j}{j}" + "".join(f" - l{j}{m} * l{j}{m}" for m in range(j))
        factor.append(f"sqrt(greatest({own}, {FLOOR[j] * 1e-6!r})) AS l{j}{j}")
        for i in range(j + 1, P):
            rest = f"c{i}{j}" + "".join(f" - l{i}{m} * l{j}{m}" for m in range(j))
            factor.append(f"({rest}) / l{j}{j} AS l{i}{j}")
        det += f" * (l{j}{j} / {GRID}) * (l{j}{j} / {GRID})"
    return f"""(SELECT {kept}, {', '.join(MEANS)}, {', '.join(factor)}, {det} AS new
        FROM (SELECT *, {', '.join(covariance)} FROM {source}))"""


def _estimate(source: str, grow: float, kept: str) -> str:
    means = ", ".join(f"{x} / n AS {m}" for x, m in zip(XS, MEANS))
    covariance = [
        f"{grow!r} * (s{i}{j} / n - {MEANS[i]} * {MEANS[j]})" + (f" + {FLOOR[i]!r}" if i == j else "")
        + f" AS c{i}{j}" for i, j in PAIRS
    ]
    return _factor(covariance, f"(SELECT *, {means} FROM {source})", kept)


def _starts() -> str:
    """The medians with three covariances; see ``quality_rules._starts``."""
    middles = ", ".join(
        f"quantile_disc({x}, 0.5) AS {m}, greatest((quantile_disc({x}, 0.75) - quantile_disc({x}, 0.25)) / 1.349e0, "
        f"{w * GRID!r}) AS q{k}" for k, (x, m, w) in enumerate(zip(XS, MEANS, WIDTHS)))
    away = ", ".join(
        f"greatest(quantile_disc(abs({x} - {m}), 0.5) / 0.6745e0, {w * GRID!r}) AS a{k}"
        for k, (x, m, w) in enumerate(zip(XS, MEANS, WIDTHS)))
    over = ", ".join(f"({x} - {m}) / a{k} AS v{k}" for k, (x, m) in enumerate(zip(XS, MEANS)))
    square = " + ".join(f"v{k} * v{k}" for k in range(P))
    directions = ", ".join(f"sum(floor(v{i} * v{j} / r * {FINE} + 0.5e0)) AS s{i}{j}" for i, j in PAIRS)
    spread = [
        f"coalesce(s{i}{j} / n * {P / FINE!r} * a{i} * a{j}, 0e0)" + (f" + {FLOOR[i]!r}" if i == j else "")
        + f" AS c{i}{j}" for i, j in PAIRS
    ]

    def diagonal(name):
        return ", ".join(f"{name}{i} AS l{i}{j}" if i == j else f"0e0 AS l{i}{j}" for i, j in PAIRS)

    means = ", ".join(MEANS)
    return f"""
middles AS (SELECT g, {middles} FROM points GROUP BY g),
marginals AS (
    SELECT * FROM middles JOIN (
        SELECT g, {away} FROM points JOIN middles USING (g) GROUP BY g, {means}) USING (g)),
directions AS (
    SELECT g, count(*)::DOUBLE AS n, {directions}
    FROM (SELECT *, {square} AS r FROM (SELECT g, {over} FROM points JOIN marginals USING (g))) WHERE r > 0
    GROUP BY g),
starts AS (
    SELECT g, 0 AS start, {means}, {diagonal("q")} FROM marginals
    UNION ALL SELECT g, 1, {means}, {diagonal("a")} FROM marginals
    UNION ALL SELECT g, 2, {ESTIMATE} FROM
        {_factor(spread, "(SELECT * FROM marginals LEFT JOIN directions USING (g))", "g")})"""


def _steps() -> str:
    totals = ", ".join([f"sum({x}) AS {x}" for x in XS] + [f"sum(s{i}{j}) AS s{i}{j}" for i, j in PAIRS])

    def away(estimates, kept):
        return f"""(SELECT {kept}, {', '.join(XS)}, {_distance()}
            FROM points p JOIN {estimates} e ON p.g = e.g)"""

    half = f"""(
        SELECT g, start, det, sum(n)::DOUBLE AS n, {totals} FROM (
            SELECT *, coalesce(sum(n) OVER (PARTITION BY g, start ORDER BY ring
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
                sum(n) OVER (PARTITION BY g, start) AS whole
            FROM (
                SELECT g, start, det, ring, count(*) AS n, {SUMS} FROM (
                    SELECT *, floor(ln({SQUARES} + 1e-3) * {RINGS}) AS ring
                    FROM {away("steps", "p.g, start, det")})
                GROUP BY g, start, det, ring))
        WHERE before < ceil({COVER!r} * whole) GROUP BY g, start, det)"""
    inside = f"""(
        SELECT g, count(*)::DOUBLE AS n, {SUMS} FROM {away("best", "p.g")}
        WHERE {SQUARES} <= {chi_square_point(INSIDE, P)!r} GROUP BY g)"""
    return f"""
steps AS (
    SELECT g, start, {ESTIMATE}, NULL::DOUBLE AS det FROM starts
    UNION ALL
    SELECT g, start, {ESTIMATE}, new FROM {_estimate(half, consistency(COVER), "g, start, det")}
    WHERE det IS NULL OR new < det * {1 - FALL!r}),
best AS (SELECT DISTINCT ON (g) * FROM steps WHERE det IS NOT NULL ORDER BY g, det, start),
estimates AS (SELECT g, {ESTIMATE} FROM {_estimate(inside, consistency(INSIDE), "g")})"""


def quality_sql() -> str:
    limit = chi_square_point(1 - TAIL, P)
    return f"""WITH RECURSIVE {STATISTICS},{_starts()},{_steps()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND coalesce({SQUARES} <= {limit!r}, true) AS kept
FROM (SELECT rows.*, {_distance()} FROM rows LEFT JOIN estimates e ON rows.g = e.g)"""
