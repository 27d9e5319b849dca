"""What differs between carriers: page layout, required fields, rules and bill-of-lading profile."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame

from ..operators.ocr import Profile
from ..operators.pages import parse_vendor_a, parse_vendor_b

# Fields without which an invoice isn't billed, in the order they are asked for.
REQUIRED = ["invoice_number", "invoice_date", "ship_date", "shipper", "consignee", "so_number", "total_amount", "past_due_date"]


@dataclass(frozen=True)
class VendorSpec:
    key: str
    bill_name: str
    company: str
    parse: Callable[[DataFrame], DataFrame]
    categories: dict[str, str]
    required: list[str] = field(default_factory=lambda: list(REQUIRED))
    profile: Profile = Profile()
    carrier_tokens: tuple[str, ...] = ()
    carrier_codes: tuple[str, ...] = ()

    def for_payer(self, own_name: str) -> VendorSpec:
        """The vendor, with the paying company's name as the lower anchor of its forms."""
        return replace(self, profile=replace(self.profile, lower_anchor=own_name.lower()))


# Names on bills and categories by shipper, in the order they are tried.
VENDORS = {
    "a": VendorSpec("a", "Badger State Western, Inc.", "Badger State Western", parse_vendor_a, {"Midwest Refrigerated Services": "Product Delivery - Customer:Outbound Transport - MRS", "Old Wisconsin Sausage Company": "5127 Product Delivery - Customer:Old Wisconsin", "DairyFood USA": "5128 Product Delivery - Customer:Dairyfood"}, carrier_tokens=("badger",), carrier_codes=("bdgw", "bogw")),
    "b": VendorSpec("b", "Scotlynn USA Division, Inc.", "Scotlynn", parse_vendor_b, {"Midwest Refrigerated Services": "Product Delivery - Customer:Outbound Transport - MRS", "OLD WISCONSIN": "5127 Product Delivery - Customer:Old Wisconsin", "DairyFood USA": "5128 Product Delivery - Customer:Dairyfood"}),
}
