from tripkpi.functions.derive import derive, payment_label, trip_columns
from tripkpi.functions.exact import Measure

__all__ = ["Measure", "derive", "payment_label", "trip_columns"]
