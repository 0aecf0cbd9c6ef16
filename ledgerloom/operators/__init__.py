from ledgerloom.operators.aggregates import (
    adults_sql,
    average_by,
    count_by,
    count_by_value,
    customer_totals_sql,
    min_by_key,
    reduce_numbers,
    total_by,
)
from ledgerloom.operators.graph import graph_degree, min_degree_ties
from ledgerloom.operators.relational import (
    dedup_by_key,
    distinct_keys,
    fk_valid,
    null_tokens,
    only_value,
    require,
    row_counts,
    take_ordered,
    top,
)
from ledgerloom.operators.similarity import (
    item_similarity,
    item_title,
    pair_stats,
    save_similarities,
    similar_items_lookup,
    similar_items_stored,
    similar_items_topk,
    user_item_moments,
)
from ledgerloom.operators.strong_similarity import strong_candidates, strong_similarities
from ledgerloom.operators.text import level_words, split_words, word_count, word_lengths

__all__ = [
    "adults_sql",
    "average_by",
    "count_by",
    "count_by_value",
    "customer_totals_sql",
    "dedup_by_key",
    "distinct_keys",
    "fk_valid",
    "graph_degree",
    "item_similarity",
    "item_title",
    "level_words",
    "min_by_key",
    "min_degree_ties",
    "null_tokens",
    "only_value",
    "pair_stats",
    "reduce_numbers",
    "require",
    "row_counts",
    "save_similarities",
    "similar_items_lookup",
    "similar_items_stored",
    "similar_items_topk",
    "split_words",
    "strong_candidates",
    "strong_similarities",
    "take_ordered",
    "top",
    "total_by",
    "user_item_moments",
    "word_count",
    "word_lengths",
]
