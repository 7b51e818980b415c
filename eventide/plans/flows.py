"""Mapping definitions used by the registered queries (configuration)."""

from __future__ import annotations

from eventide.model import Flow, m
from eventide.sources.adapters import ORDERS_TOPIC

ORDERS_CLEAN = Flow(
    name="orders-clean", source_topic=ORDERS_TOPIC, destination_topic="orders.clean", state="ACTIVE",
    mappings=(
        m("orderId", "order.id"),
        m("total", "order.amount", "TO_DOUBLE"),
        m("status", "order.status", "TO_LOWER"),
        m("customer.id", "customer.id", "TO_STRING"),
        m("customer.name", "customer.name", "MASK"),
        m("customer.segment", "customer.segment", "TO_LOWER"),
        m("customer.balance", "customer.balance", "TO_INTEGER"),
        m("customer.nation", "customer.nationCode", "TO_LONG"),
        m("priority", "priority", excluded=True),
        m("currency", "currency", default="USD"),
        m("coupon", "coupon"),
        m("processedAt", "meta.processedAt", default="${now}"),
        m("traceId", "meta.traceId", default="${uuid}"),
    ))

ORDERS_AUDIT = Flow(
    name="orders-audit", source_topic=ORDERS_TOPIC, destination_topic="orders.audit",
    dead_letter_topic="orders.audit.failed", state="DRAFT", version=2,
    mappings=(
        m("orderId", "id", "TO_STRING"),
        m("customer", "", "FLATTEN"),
        m("priority", "priority", "TO_UPPER"),
    ))

ORDERS_PAUSED = Flow(
    name="orders-paused", source_topic=ORDERS_TOPIC, destination_topic="orders.paused",
    state="PAUSED", mappings=(m("orderId", "id"),))

# An older version of the audit definition: superseded by version 2 (TOP-5).
ORDERS_AUDIT_V1 = Flow(
    name="orders-audit", source_topic=ORDERS_TOPIC, destination_topic="orders.audit.v1", state="ACTIVE",
    version=1, mappings=(m("orderId", "id"),))

ALL_FLOWS = (ORDERS_CLEAN, ORDERS_AUDIT_V1, ORDERS_AUDIT, ORDERS_PAUSED)
