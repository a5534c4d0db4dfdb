"""End-to-end jobs built from the operators.

Modules: ``delta_sweep`` (registry sweep), ``feed_reconciliation`` (feed
clean-up and record diff), ``report`` (count consolidation and report rows).
"""
