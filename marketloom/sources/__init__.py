"""Inputs: raw payloads, landed envelopes, stored layers, snapshots, and the sample order tables."""
