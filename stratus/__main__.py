from stratus.cli import main

main()
