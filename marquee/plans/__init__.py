"""The layered tables: staging, intermediate, marts, consumer queries."""
