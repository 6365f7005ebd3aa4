"""The derived tables and shared expressions once more as ANSI SQL, for the side-by-side check."""

from __future__ import annotations

import re

CTES: dict[str, str] = {
    "doc_hashes": "SELECT doc_id, sha256(text) AS molecule_hash FROM documents",
    "registry_raw": """
        SELECT sha256(text) AS molecule_hash, text AS smiles,
               'gen_shard' || regexp_extract(source, '(\\d+)', 1) || '_idx' || doc_id AS global_id,
               'store://generated/shard_' || regexp_extract(source, '(\\d+)', 1) || '/SDF/' || doc_id || '.sdf' AS sdf_path,
               CASE WHEN doc_id % 10 = 0 THEN 'cycle2' ELSE 'cycle1' END AS run_id, doc_id AS seq
        FROM documents""",
    "registry": """
        SELECT * FROM registry_raw QUALIFY row_number() OVER (PARTITION BY molecule_hash ORDER BY seq) = 1""",
    "screening_raw": """
        SELECT sha256(d.text) AS molecule_hash, d.doc_id AS seq,
               CASE WHEN d.doc_id % 13 <> 0 THEN 0.0 - CAST((d.doc_id * 37) % 700 AS DOUBLE) / 10 END AS docking_score,
               CAST((d.doc_id * 17) % 101 AS DOUBLE) / 100 AS qed_score,
               1 + CAST((d.doc_id * 29) % 91 AS DOUBLE) / 10 AS sa_score,
               CAST((d.doc_id * 31) % 90 AS DOUBLE) / 10 - 2 AS logp,
               CAST(150 + (d.doc_id * 53) % 500 AS DOUBLE) AS mw,
               CAST(l.toxic AS INTEGER) AS toxicity_label
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "screening": """
        SELECT * FROM screening_raw QUALIFY row_number() OVER (PARTITION BY molecule_hash ORDER BY seq) = 1""",
    "oracle_raw": """
        SELECT h.molecule_hash, 0.0 - l_quantity AS delta_g,
               CASE WHEN l_returnflag = 'R' THEN 'Failed_Analysis' ELSE 'Success' END AS status,
               l_suppkey AS batch_id, l_linenumber AS attempt,
               CAST(date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) AS INTEGER) AS day, l_partkey AS task
        FROM lineitem JOIN doc_hashes h ON h.doc_id = l_orderkey % (SELECT count(*) FROM documents)""",
    "oracle_best": """
        SELECT * FROM oracle_raw QUALIFY row_number() OVER (
            PARTITION BY molecule_hash
            ORDER BY CASE WHEN status = 'Success' THEN 0 ELSE 1 END,
                     CASE WHEN status = 'Success' THEN delta_g END, day, attempt, batch_id, task, delta_g) = 1""",
    "gold": """
        SELECT molecule_hash, CASE WHEN status = 'Success' THEN delta_g END AS delta_g, 'mmpbsa' AS method, status,
               'run' || (batch_id % 3) AS run_id, day
        FROM oracle_best
        WHERE molecule_hash IN (SELECT molecule_hash FROM doc_hashes JOIN labels USING (doc_id))""",
    "predictions": """
        SELECT h.molecule_hash, p_partkey AS seq, 0.0 - p_retailprice / 25 AS predicted_delta_g,
               p_brand AS model_version, p_type AS run_id
        FROM part JOIN doc_hashes h ON h.doc_id = p_partkey
        QUALIFY row_number() OVER (PARTITION BY h.molecule_hash ORDER BY p_partkey) = 1""",
    "unified": """
        SELECT s.*, coalesce(g.delta_g, p.predicted_delta_g) AS final_score,
               CASE WHEN g.delta_g IS NOT NULL THEN 'gromacs' WHEN p.molecule_hash IS NOT NULL THEN 'xgboost' END AS score_method
        FROM screening s
        LEFT JOIN predictions p ON p.molecule_hash = s.molecule_hash
        LEFT JOIN gold g ON g.molecule_hash = s.molecule_hash""",
    "cycles": """
        SELECT r.run_id AS cycle, u.molecule_hash, u.final_score, u.qed_score, u.sa_score, u.logp, u.mw,
               u.toxicity_label, u.score_method, u.docking_score
        FROM unified u JOIN registry r ON r.molecule_hash = u.molecule_hash""",
    "valid_rows": "SELECT * FROM screening WHERE toxicity_label = 0 AND qed_score > 0.4 AND sa_score < 6.0",
    "exploit": """
        SELECT molecule_hash, 'exploitation' AS strategy FROM valid_rows
        ORDER BY docking_score ASC NULLS LAST, molecule_hash LIMIT 80""",
    "explore": """
        SELECT molecule_hash, 'exploration' AS strategy FROM valid_rows
        WHERE molecule_hash NOT IN (SELECT molecule_hash FROM exploit)
        ORDER BY md5('label' || molecule_hash), molecule_hash LIMIT 20""",
    "selected": "SELECT * FROM exploit UNION ALL SELECT * FROM explore",
    "elite": "SELECT * FROM unified WHERE sa_score < 4.0 AND qed_score > 0.5",
}


def with_tables(body: str) -> str:
    """Prefix ``body`` with the derived tables it mentions, directly or through others."""
    need: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for name in CTES:
            if name not in need and re.search(rf"\b{name}\b", text):
                need.add(name)
                todo.append(CTES[name])
    if not need:
        return body
    head = ", ".join(f"{name} AS ({CTES[name].strip()})" for name in CTES if name in need)
    text = body.strip()
    if text.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {head}, {text[15:]}"
    if text.upper().startswith("WITH "):
        return f"WITH {head}, {text[5:]}"
    return f"WITH {head} {text}"
