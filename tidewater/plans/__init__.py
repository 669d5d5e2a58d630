"""Model plans: staging, intermediate, marts, reports, checks, derivations."""
