"""Small models in the form of node tables, for the queries over the test tables.

Columns: tree, node, feature, threshold, yes, no, missing, leaf.
"""

from __future__ import annotations

from featuremart.functions.classes import (
    EDUCATION_CLASSES,
    INCOME_CLASSES,
    OCCUPATION_CLASSES,
    REGION_CLASSES,
    UNDEFINED,
)
from featuremart.operators.scoring import Node, TreeModel
from featuremart.plans.dataset import FEATURES
from featuremart.plans.scores import CATEGORICAL

# Labels in code-point order over all classes that exist: what an encoder fitted on data with
# every class would hold.
CLASS_LABELS = dict(
    zip(
        CATEGORICAL,
        (
            sorted([*EDUCATION_CLASSES, UNDEFINED]),
            sorted([*OCCUPATION_CLASSES, UNDEFINED]),
            sorted(INCOME_CLASSES),
            sorted(REGION_CLASSES),
        ),
        strict=True,
    )
)

# Works on the features of the inference dataset; labels are codes.
CARD_MODEL = TreeModel(
    tuple(
        Node(*row)
        for row in (
            (0, 0, "demog_personal_usia_na_na", 35.0, 1, 2, 1, None),
            (0, 1, "saving_casa_aktif_sum_na", 250000.0, 3, 4, 3, None),
            (0, 2, "demog_id_rgdesc_na_na", 3.0, 5, 6, 6, None),
            (0, 3, None, None, None, None, None, -1.9),
            (0, 4, None, None, None, None, None, -1.2),
            (0, 5, None, None, None, None, None, -1.5),
            (0, 6, None, None, None, None, None, -2.1),
            (1, 0, "ddhist_na_income_sum_180d", 50000.0, 1, 2, 1, None),
            (1, 1, None, None, None, None, None, -1.4),
            (1, 2, "demog_personal_penghasilan_perbulan_na_na", 2.0, 3, 4, 4, None),
            (1, 3, None, None, None, None, None, -0.7),
            (1, 4, None, None, None, None, None, -1.1),
            (2, 0, "transaction_ratio_sumcasa_sumtrxcred_na_l30d", 0.5, 1, 2, 1, None),
            (2, 1, "demog_is_pinjaman_aktif_na_na", 1.0, 3, 4, 3, None),
            (2, 2, None, None, None, None, None, -0.2),
            (2, 3, None, None, None, None, None, -1.0),
            (2, 4, None, None, None, None, None, -0.6),
        )
    )
)



def ensemble(trees: int, depth: int = 3) -> TreeModel:
    """An ensemble over all features of the jobs, of the size a trained one has.

    Splits and leaves follow from the numbers of tree and node, so it is the same in every run.
    """
    nodes = []
    for tree in range(trees):
        for node in range(2 ** (depth + 1) - 1):
            mix = (tree * 31 + node * 17 + 7) % 97
            if node >= 2**depth - 1:
                nodes.append(Node(tree, node, None, None, None, None, None, (mix - 52) / 1000))
                continue
            feature = FEATURES[(tree * 5 + node * 3) % len(FEATURES)]
            scale = SCALES.get(feature, 6.0)
            yes, no = 2 * node + 1, 2 * node + 2
            nodes.append(
                Node(tree, node, feature, scale * mix / 97, yes, no, yes if mix % 2 else no, None)
            )
    return TreeModel(tuple(nodes))


# Spread of the features that are not codes.
SCALES = {
    "demog_personal_usia_na_na": 90.0, "saving_casa_aktif_sum_na": 800000.0,
    "ddhist_na_income_sum_180d": 200000.0, "transaction_ratio_sumcasa_sumtrxcred_na_l30d": 20.0,
    "transaction_ratio_sumcasatd_sumtrxdeb_na_l30d": 20.0,
}
ENSEMBLE = ensemble(160)

# Works on the two totals of the portfolio rollup.
BALANCE_MODEL = TreeModel(
    tuple(
        Node(*row)
        for row in (
            (0, 0, "saving_casa_aktif_count_na", 2.0, 1, 2, 1, None),
            (0, 1, None, None, None, None, None, -3.0),
            (0, 2, "saving_casa_aktif_sum_na", 600000.0, 3, 4, 3, None),
            (0, 3, None, None, None, None, None, -2.0),
            (0, 4, None, None, None, None, None, -1.0),
            (1, 0, "saving_casa_aktif_sum_na", 100000.0, 1, 2, 2, None),
            (1, 1, None, None, None, None, None, -1.5),
            (1, 2, None, None, None, None, None, -0.5),
        )
    ),
    base_score=0.25,
)
BALANCE_FEATURES = ("saving_casa_aktif_count_na", "saving_casa_aktif_sum_na")
