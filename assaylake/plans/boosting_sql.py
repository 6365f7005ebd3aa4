"""SQL text of the boosted trees, one common table per level, for the side-by-side check."""

from __future__ import annotations

from assaylake.operators.proxy import LEARNING_RATE, N_BITS, TRAIN_SHARE

_HASH = "CAST(('0x' || substr(md5('{seed}' || molecule_hash), 1, 8)) AS BIGINT)"

# every registered string of three characters or more with its bits, label and split
FEATURES = f"""
    bt_rows AS MATERIALIZED (
        SELECT molecule_hash, smiles, delta_g AS label, CAST(floor(delta_g * 1000000 + 0.5) AS BIGINT) AS y,
               CASE WHEN {_HASH.format(seed='proxy')} < CAST({TRAIN_SHARE} * 4294967296 AS BIGINT) THEN 'train' ELSE 'test' END AS split
        FROM registry LEFT JOIN gold USING (molecule_hash) WHERE length(smiles) >= 3),
    bt_bits AS MATERIALIZED (
        SELECT DISTINCT molecule_hash, CAST(CAST(('0x' || substr(md5(gram), 1, 8)) AS BIGINT) % {N_BITS} AS INTEGER) AS bit
        FROM (SELECT DISTINCT molecule_hash, substr(smiles, i, 3) AS gram
              FROM (SELECT molecule_hash, smiles, unnest(range(1, length(smiles) - 1)) AS i FROM bt_rows)))"""


def trees(name: str, weight: str, n_trees: int, depth: int, rate: float = LEARNING_RATE) -> str:
    """Common tables of a model: ``{name}_pred`` (molecule_hash, p) of all rows and ``{name}_splits`` (tree, node, bit, gain, n).

    ``weight`` is a whole number for each row of bt_rows; rows of weight 0 or without a label do not train.
    """
    base = "CAST(floor(CAST(sum(w * y) AS DOUBLE) / CAST(sum(w) AS DOUBLE) + 0.5) AS BIGINT)"
    out = [f"""{name}_w AS MATERIALIZED (SELECT *, CASE WHEN y IS NULL THEN 0 ELSE {weight} END AS w FROM bt_rows),
    {name}_p0 AS MATERIALIZED (SELECT molecule_hash, w, y, (SELECT {base} FROM {name}_w WHERE w > 0) AS p FROM {name}_w)"""]
    splits = []
    for t in range(n_trees):
        out.append(f"{name}_n{t}_0 AS MATERIALIZED (SELECT molecule_hash, w, y, p, y - p AS r, 1 AS node FROM {name}_p{t})")
        for level in range(depth):
            now, key = f"{name}_n{t}_{level}", f"{name}_s{t}_{level}"
            splits.append(f"SELECT {t} AS tree, node, bit, gain, n FROM {key}")
            out.append(f"""{key} AS MATERIALIZED (
        SELECT node, bit, gain, n FROM (
            SELECT node, bit, n, n1, CAST(s1 AS DOUBLE) * CAST(s1 AS DOUBLE) / CAST(n1 AS DOUBLE)
                       + CAST(s - s1 AS DOUBLE) * CAST(s - s1 AS DOUBLE) / CAST(n - n1 AS DOUBLE) - CAST(s AS DOUBLE) * CAST(s AS DOUBLE) / CAST(n AS DOUBLE) AS gain
            FROM (SELECT node, bit, sum(w) AS n1, sum(w * r) AS s1 FROM {now} JOIN bt_bits USING (molecule_hash) WHERE w > 0 GROUP BY ALL)
            JOIN (SELECT node, sum(w) AS n, sum(w * r) AS s FROM {now} WHERE w > 0 GROUP BY ALL) USING (node)
            WHERE n1 < n AND node >= {1 << level})
        WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, bit) = 1)""")
            out.append(f"""{name}_n{t}_{level + 1} AS MATERIALIZED (
        SELECT a.molecule_hash, a.w, a.y, a.p, a.r, CASE WHEN s.bit IS NULL THEN a.node WHEN b.bit IS NULL THEN 2 * a.node ELSE 2 * a.node + 1 END AS node
        FROM {now} a LEFT JOIN {key} s ON s.node = a.node LEFT JOIN bt_bits b ON b.molecule_hash = a.molecule_hash AND b.bit = s.bit)""")
        last = f"{name}_n{t}_{depth}"
        out.append(f"""{name}_p{t + 1} AS MATERIALIZED (
        SELECT a.molecule_hash, a.w, a.y, a.p + v.value AS p FROM {last} a
        JOIN (SELECT node, CAST(floor({rate} * (CAST(sum(w * r) AS DOUBLE) / CAST(sum(w) AS DOUBLE)) + 0.5) AS BIGINT) AS value
              FROM {last} WHERE w > 0 GROUP BY node) v USING (node))""")
    out.append(f"{name}_pred AS (SELECT molecule_hash, CAST(p AS DOUBLE) / 1000000.0 AS p FROM {name}_p{n_trees})")
    out.append(f"{name}_splits AS ({' UNION ALL '.join(splits)})")
    return ", ".join(out)


def model(n_trees: int, depth: int, weight: str = "1") -> str:
    return f"WITH {FEATURES}, {trees('m', weight, n_trees, depth)}"


def poisson(member: int) -> str:
    """Copies of a row in bootstrap sample ``member``."""
    u = f"((CAST({_HASH.format(seed=f'boot{member}-')} AS DOUBLE) + 0.5) / 4294967296.0)"
    cuts = [0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563]
    return "CASE " + " ".join(f"WHEN {u} < {c}::DOUBLE THEN {i}" for i, c in enumerate(cuts)) + f" ELSE {len(cuts)} END"
