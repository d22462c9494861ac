"""Column expressions: cleaning, shipment measures and rating rules."""
