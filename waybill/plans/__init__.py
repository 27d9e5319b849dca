"""Vendor specifications, the batch run and the registered queries."""
