"""Generic DataFrame operators: merges, ordered numbering, contracts."""
from claimweave.operators.contracts import check_contracts, check_models  # noqa: F401
from claimweave.operators.merge import (  # noqa: F401
    first_by_key,
    insert_missing,
    merge_by_key,
    missing_from,
    replace_window,
)
from claimweave.operators.ordered import assign_ids, carry_forward, running_number  # noqa: F401
from claimweave.operators.skew import many_to_one  # noqa: F401
