"""Column-level rules shared by the operators."""

from ledgerlens.functions.rules import (  # noqa: F401
    bin_index, case_type, class_label, cluster_type, feature_group, hash_bucket,
    ratio, safe_div,
)
