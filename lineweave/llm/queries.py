"""Registered queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from lineweave.llm.decontaminate import op6_decontaminate
from lineweave.llm.fill_middle import OP13_SQL, op13_fill_middle
from lineweave.llm.fingerprint import op2_fingerprint
from lineweave.llm.license_scan import op4_license_scan
from lineweave.llm.near_dedup import op3_near_dedup
from lineweave.llm.ngram_join import OP11_SQL, components_sql, op11_jaccard_join
from lineweave.llm.packing import op8_pack
from lineweave.llm.periodic_runs import OP12_SQL, op12_periodic_runs
from lineweave.llm.quality import op10_quality
from lineweave.llm.substring_dedup import OP7_SQL, op7_substring_dedup
from lineweave.llm.token_output import op5_token_ids
from lineweave.llm.toxicity import op1_toxicity
from lineweave.llm.warc import op9_warc

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_fingerprint": op2_fingerprint,
    "op3_near_dedup": op3_near_dedup,
    "op4_license_scan": op4_license_scan,
    "op5_token_ids": op5_token_ids,
    "op6_decontaminate": op6_decontaminate,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_pack": op8_pack,
    "op9_warc": op9_warc,
    "op10_quality": op10_quality,
    "op11_jaccard_join": op11_jaccard_join,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_fill_middle": op13_fill_middle,
}

SQL: dict[str, str] = {
    "op3_near_dedup": f"SELECT *, doc_id = component_id AS kept FROM ({components_sql(85)})",
    "op7_substring_dedup": OP7_SQL,
    "op11_jaccard_join": OP11_SQL,
    "op12_periodic_runs": OP12_SQL,
    "op13_fill_middle": OP13_SQL,
    "op9_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
        m AS (SELECT d, max(page_id) AS top FROM p WHERE n >= 1000 GROUP BY d)
        SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
               CASE WHEN n >= 1000 AND top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND top <> page_id THEN top END AS refers_to
        FROM p LEFT JOIN m ON p.d = m.d
    """,
}
