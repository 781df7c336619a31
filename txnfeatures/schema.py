"""Column contracts and the per-dataset mapping that drives every plan."""

from __future__ import annotations

from dataclasses import dataclass, field, replace


# The 18 model features in contract order, with their types.
FEATURE_TYPES = {
    "log_amount": "double",
    "amount_z": "double",
    "is_high_amount": "int",
    "hour": "double",
    "hour_sin": "double",
    "hour_cos": "double",
    "is_night": "int",
    "day_of_week": "int",
    "is_weekend": "int",
    "txn_month": "int",
    "user_mean_amount": "double",
    "user_std_amount": "double",
    "user_txn_count": "bigint",
    "user_amount_z": "double",
    "txn_count_5m": "bigint",
    "pca_l2": "double",
    "pca_max_abs": "double",
    "pca_mean": "double",
}

FEATURE_COLS = list(FEATURE_TYPES)

UNIVERSAL_TYPES = {**FEATURE_TYPES, "label": "int", "source": "string"}
UNIVERSAL_COLS = list(UNIVERSAL_TYPES)

# The first version of the contract has the global rank after the z-score.
UNIVERSAL_TYPES_V1 = {}
for _name, _dtype in UNIVERSAL_TYPES.items():
    UNIVERSAL_TYPES_V1[_name] = _dtype
    if _name == "amount_z":
        UNIVERSAL_TYPES_V1["amount_pct"] = "double"
UNIVERSAL_COLS_V1 = list(UNIVERSAL_TYPES_V1)

PCA_COLS = [f"V{i}" for i in range(1, 29)]

BUCKET_SECONDS = 300


@dataclass(frozen=True)
class SourceSpec:
    """How one dataset maps onto the universal contract.

    ``time_kind`` is ``"datetime"`` (text or timestamp), ``"numeric"`` (seconds
    since the first row) or ``None``; ``label_kind`` is ``"bool"`` (anything but
    true is 0) or ``"int"`` (null stays null).
    """

    name: str
    amount: str = "Amount"
    time: str | None = None
    time_kind: str | None = "datetime"
    user: str | None = None
    label: str | None = None
    label_kind: str = "int"
    pca: tuple[str, ...] = ()
    uri: str | None = None
    types: str | None = None
    renames: dict[str, str] = field(default_factory=dict)
    repartition: int | None = None

    def at(self, uri: str) -> "SourceSpec":
        return replace(self, uri=uri)


# Names of the three training datasets and of the scoring set,
# with the columns their files carry.
FINANCIAL = SourceSpec(
    name="financial",
    amount="Amount",
    time="timestamp",
    user="sender_account",
    label="is_fraud",
    label_kind="bool",
    renames={"amount": "Amount"},
    types=(
        "transaction_id string, timestamp string, sender_account string, "
        "receiver_account string, amount double, transaction_type string, "
        "merchant_category string, location string, device_used string, "
        "is_fraud boolean, fraud_type string"
    ),
)

CREDITCARD = SourceSpec(
    name="creditcard",
    amount="Amount",
    time="Time",
    time_kind="numeric",
    label="Class",
    pca=tuple(PCA_COLS),
    types="Time double, " + ", ".join(f"{v} double" for v in PCA_COLS) + ", Amount double, Class int",
)

CARD_FRAUD = SourceSpec(
    name="credit_card_fraud",
    amount="Amount",
    time="TransactionDate",
    user="MerchantID",
    label="IsFraud",
    types=(
        "TransactionID string, TransactionDate string, Amount double, MerchantID string, "
        "TransactionType string, Location string, IsFraud int"
    ),
)

MIXED = SourceSpec(
    name="mixed_1M",
    amount="Amount",
    time="timestamp",
    user="sender_account",
    label="IsFraud",
    types="Amount double, timestamp string, sender_account string, IsFraud int",
)
