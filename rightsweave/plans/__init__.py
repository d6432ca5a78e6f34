"""Domain jobs: territories, contract chains, restitution."""
