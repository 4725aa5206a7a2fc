"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from textflow.llm.bpe import op5_byte_bpe
from textflow.llm.decontaminate import op8_decontaminate
from textflow.llm.exact_dedup import op1_grace_dedup
from textflow.llm.hard_negatives import op11_hard_negatives
from textflow.llm.html_extract import op6_html_extract
from textflow.llm.lang_id import op10_lang_id
from textflow.llm.near_dedup import op2_near_dedup
from textflow.llm.packing import op12_best_fit_packing
from textflow.llm.secrets import op9_secret_scan
from textflow.llm.spelling import op13_spelling_variants
from textflow.llm.token_counts import op4_token_counts
from textflow.llm.token_files import op3_token_files
from textflow.llm.url_filter import op7_url_filter

REGISTRY = {
    "op1_grace_dedup": op1_grace_dedup,
    "op2_near_dedup": op2_near_dedup,
    "op3_token_files": op3_token_files,
    "op4_token_counts": op4_token_counts,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_html_extract": op6_html_extract,
    "op7_url_filter": op7_url_filter,
    "op8_decontaminate": op8_decontaminate,
    "op9_secret_scan": op9_secret_scan,
    "op10_lang_id": op10_lang_id,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_spelling_variants": op13_spelling_variants,
}

_LOWER = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz')")
_WORDS = (f"regexp_extract_all({_LOWER}, "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

ORACLE = {
    "op1_grace_dedup": f"""
        WITH t AS (SELECT doc_id, {_LOWER} AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id,
               count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept,
               sha256(t) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY t)""",
    "op8_decontaminate": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        b AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id,
                     {_WORDS} AS w FROM benchmark),
        win AS (SELECT DISTINCT item_id, least(13, len(w)) AS n,
                       array_to_string(list_slice(w, i, i + 12), ' ') AS t
                FROM (SELECT item_id, w, unnest(range(1, greatest(
                          2, len(w) - 11))) AS i FROM b WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM win),
        pos AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
               FROM d, sizes WHERE len(w) >= n),
        hit AS (SELECT doc_id, i, pos.n, item_id FROM pos JOIN win
                ON win.n = pos.n
                AND win.t = array_to_string(list_slice(w, i, i + pos.n - 1),
                                            ' ')),
        words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
                  SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit)
                  GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items,
                         string_agg(item_id, ',' ORDER BY item_id) AS s
                  FROM (SELECT DISTINCT doc_id, item_id FROM hit)
                  GROUP BY doc_id)
        SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items,
               sha256(coalesce(s, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0
                   AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
        """,
}
