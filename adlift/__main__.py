from adlift.cli import main

main()
